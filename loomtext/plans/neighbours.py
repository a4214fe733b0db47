"""Queries over known pairs, vectors of phrases, and neighbours of topics."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import neighbours as N
from ..operators import phrases as P
from ..sources.io import table
from .base import ORACLES, SQL_SENTENCES, register, sql_tokens
from .textual import bigram_phrases, texts

#: What :func:`phrases.substituted` leaves of ``{rows}`` (k, w), by ``{pairs}`` (pair), in the twin's own terms.
_SQL_SUBSTITUTED = """pr AS (SELECT k, i, w[i] AS a, w[i + 1] AS b FROM (SELECT k, w, unnest(range(1, len(w))) AS i FROM {rows})), kn AS (SELECT pr.* FROM pr JOIN {pairs} v ON v.pair = a || '_' || b),
 gone AS (SELECT k, x, count(*) AS g FROM (SELECT k, b AS x FROM kn UNION ALL SELECT k, arg_min(a, i) FROM kn GROUP BY k) GROUP BY k, x),
 un AS (SELECT k, i, x, row_number() OVER (PARTITION BY k, x ORDER BY i) AS nth FROM (SELECT k, unnest(w) AS x, generate_subscripts(w, 1) AS i FROM {rows})),
 sub AS (SELECT un.k, i, un.x AS gram FROM un LEFT JOIN gone ON gone.k = un.k AND gone.x = un.x WHERE nth > coalesce(g, 0) UNION ALL SELECT k, 1000000000 + i, a || '_' || b FROM kn)"""


@register(f"""WITH phrases AS ({ORACLES["bigram_phrases"]}), known AS (SELECT first || '_' || second AS pair FROM phrases), {SQL_SENTENCES},
 rows_ AS (SELECT {{'d': doc_id, 's': sent_idx}} AS k, {sql_tokens("sentence")} AS w FROM sent), {_SQL_SUBSTITUTED.format(rows="rows_", pairs="known")}
 SELECT k.d AS doc_id, CAST(k.s AS INTEGER) AS sent_idx, string_agg(gram, ' ' ORDER BY i) AS grams FROM sub GROUP BY k""")
def substituted_pairs(spark, d):
    """The pairs that the corpus holds for phrases, put in place of the words of every sentence."""
    known = bigram_phrases(spark, d).select(F.concat_ws("_", "first", "second").alias("pair"))
    return P.substituted_sentences(texts(spark, d), "text", known, "doc_id")


_SQL_NAMES = """names AS (SELECT DISTINCT p_name AS k, string_split(lower(p_name), ' ') AS w FROM part), nw AS (SELECT unnest(w) AS word FROM names),
 np AS (SELECT w[i] || '_' || w[i + 1] AS word FROM (SELECT w, unnest(range(1, len(w))) AS i FROM names) GROUP BY 1 HAVING count(*) >= 2),
 vec AS (SELECT DISTINCT word, length(word) AS x, ascii(word) AS y FROM nw WHERE length(word) > 4 UNION ALL SELECT word, 10 * length(word), ascii(word) FROM np), known AS (SELECT word AS pair FROM np)"""


@register(f"""WITH {_SQL_NAMES}, {_SQL_SUBSTITUTED.format(rows="names", pairs="known")}, m AS (SELECT k, avg(x) AS x, avg(y) AS y FROM sub JOIN vec ON word = gram GROUP BY k)
 SELECT k AS phrase, round(x, 9) AS x, round(y, 9) AS y FROM names LEFT JOIN m USING (k)""")
def phrase_vectors_by_pairs(spark, d):
    """Names of parts by the vectors of their words and known pairs; short words have none."""
    names = table(spark, d, "part").select(F.col("p_name").alias("phrase")).distinct()
    words = names.select(F.split(F.lower("phrase"), " ").alias("w"))
    pairs = words.select(F.explode(F.zip_with("w", F.slice("w", F.lit(2), F.size("w")), lambda a, b: F.concat(a, F.lit("_"), b))).alias("word")).filter("word is not null")
    pairs = pairs.groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter("n >= 2")
    vector = lambda scale: F.array((F.length("word") * scale).cast("double"), F.ascii("word").cast("double")).alias("vector")
    vectors = words.select(F.explode("w").alias("word")).distinct().filter("length(word) > 4").select("word", vector(1)).unionByName(pairs.select("word", vector(10)))
    out = P.embedded(names, vectors)
    return out.select("phrase", F.round(F.col("vector")[0], 9).alias("x"), F.round(F.col("vector")[1], 9).alias("y"))


_SQL_INPUTS = """e AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings), i AS (SELECT label AS topic, vec_id, v, CASE WHEN vec_id % 50 = 0 THEN 1 ELSE -1 END AS sign FROM e WHERE vec_id % 50 = 0 OR vec_id % 100 = 75),
 t AS (SELECT * FROM i WHERE topic IN (SELECT topic FROM i WHERE sign = 1))"""


def topic_inputs(spark, d):
    """The stated inputs: every fiftieth vector for its label, and some against it."""
    e = table(spark, d, "embeddings").filter("vec_id % 50 = 0 or vec_id % 100 = 75")
    return e.select(F.col("label").alias("topic"), "vec_id", "embedding", F.when(F.col("vec_id") % 50 == 0, 1).otherwise(-1).alias("sign"))


@register(f"""WITH {_SQL_INPUTS}, s AS (SELECT topic, e.vec_id, coalesce(product((1 + list_cosine_similarity(t.v, e.v)) / 2) FILTER (sign = 1), 1) / (coalesce(product((1 + list_cosine_similarity(t.v, e.v)) / 2) FILTER (sign = -1), 1) + 0.000001) AS score
 FROM t, e GROUP BY topic, e.vec_id HAVING bool_and(t.vec_id <> e.vec_id)) SELECT topic, vec_id, round(score, 8) AS score FROM s QUALIFY row_number() OVER (PARTITION BY topic ORDER BY score DESC, vec_id) <= 50""")
def topic_neighbours_product(spark, d):
    """The 50 nearest of each topic by the multiplicative form, over all vectors."""
    return N.nearest_by_product(topic_inputs(spark, d), table(spark, d, "embeddings")).select("topic", "vec_id", F.round("score", 8).alias("score"))


@register(f"""WITH {_SQL_INPUTS}, u AS (SELECT topic, sign * unnest(v) / sqrt(list_dot_product(v, v)) AS x, generate_subscripts(v, 1) AS dim FROM t), m AS (SELECT topic, dim, avg(x) AS x FROM u GROUP BY ALL), q AS (SELECT topic, list(x ORDER BY dim) AS q FROM m GROUP BY topic),
 s AS (SELECT topic, vec_id, list_cosine_similarity(q, v) AS score FROM q, e WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.topic = q.topic AND t.vec_id = e.vec_id)) SELECT topic, vec_id, round(score, 8) AS score FROM s QUALIFY row_number() OVER (PARTITION BY topic ORDER BY score DESC, vec_id) <= 50""")
def topic_neighbours_mean(spark, d):
    """The 50 nearest of each topic by the cosine to its mean direction."""
    return N.nearest_by_mean(topic_inputs(spark, d), table(spark, d, "embeddings")).select("topic", "vec_id", F.round("score", 8).alias("score"))


@register()
def neighbours_by_index(spark, d):
    """Ten neighbours of every vector, by inverted lists; recall against brute force is in the tests.

    The given vectors have no clusters, so that many lists must be read for a recall of 0.9.
    """
    e = table(spark, d, "embeddings")
    return N.InvertedLists(e, cells=32).nearest(e, 10, probes=22).select("query_id", "vec_id", F.round("score", 9).alias("cosine"))
