"""Queries over text rules: cleaning, tokenizers, sentence variants, and statistics of sentences and topics."""

from __future__ import annotations

from functools import partial

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ..functions import calls
from ..functions import lexicon as L
from ..functions import scores as C
from ..functions import text as X
from ..operators import models, topics
from ..operators import vectors as V
from ..sources.io import table
from .base import SQL_SENTENCES, register, sql_list, sql_lower, sql_tokens
from .textual import _COMPLEX, _SYL, sql_bare, sql_greets, texts

#: Small tables over the synthetic corpus, in place of full ones, which sources.io reads from files.
CONTRACTIONS = {"don't": "do not", "can't": "cannot", "it's": "it is", "won't": "will not", "I'm": "I am", "the": "the one"}
STOP_WORDS = ("and", "the", "of", "a", "in")
LEMMAS = {"is": "be", "was": "be", "are": "be", "for": "four", "with": "withal"}

_MAP = lambda d: "MAP {" + ", ".join("'" + k.replace("'", "''") + f"': '{v}'" for k, v in sorted(d.items())) + "}"
SQL_EXPANDED = f"list_aggregate(list_transform(string_split(replace(text, '’', chr(39)), ' '), lambda w: coalesce(map_extract({_MAP(CONTRACTIONS)}, w)[1], w)), 'string_agg', ' ')"
SQL_CLEAN = f"""{sql_lower("trim(regexp_replace(coalesce(list_aggregate(list_filter(regexp_split_to_array(replace(" + SQL_EXPANDED + ", chr(34), ''), '[^A-Za-z0-9_]+'), lambda w: NOT regexp_full_match(w, '[A-Za-z]')), 'string_agg', ' '), ''), '[^A-Za-z]+', ' ', 'g'))")}"""


def sql_lemma(w: str) -> str:
    return f"coalesce(map_extract({_MAP(LEMMAS)}, {w})[1], {w})"


def sql_content(column: str) -> str:
    return f"list_filter(list_transform({sql_tokens(column)}, lambda w: {sql_lemma('w')}), lambda w: w NOT IN {sql_list(STOP_WORDS)})"


@register(f"SELECT doc_id, {SQL_CLEAN} AS cleaned FROM documents")
def clean_text(spark, d):
    """X3, X3b, X2."""
    return texts(spark, d).select("doc_id", X.clean(F.col("text"), CONTRACTIONS).alias("cleaned"))


@register(f"SELECT doc_id, {SQL_EXPANDED} AS expanded FROM documents")
def contractions_expanded(spark, d):
    """X2."""
    return texts(spark, d).select("doc_id", X.expand_contractions(F.col("text"), CONTRACTIONS).alias("expanded"))


@register(f"SELECT token, count(*) AS n FROM (SELECT unnest({sql_content('text')}) AS token FROM documents) GROUP BY token")
def content_token_counts(spark, d):
    """Base forms by table, without stop words."""
    return texts(spark, d).select(F.explode(X.content_tokens(F.col("text"), STOP_WORDS, LEMMAS)).alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("n"))


@register(f"""SELECT token, count(*) AS n FROM (SELECT unnest(list_filter({sql_tokens("text")}, lambda w: w NOT IN {sql_list(STOP_WORDS)})) AS token FROM documents) GROUP BY token""")
def plain_token_counts(spark, d):
    """No stop words, marks or numbers; no base forms."""
    return texts(spark, d).select(F.explode(X.content_tokens(F.col("text"), STOP_WORDS)).alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("n"))


_RAW = f"list_filter(list_transform(list_filter(regexp_split_to_array({sql_lower('text')}, ' +'), lambda w: w <> ''), lambda w: {sql_lemma('w')}), lambda w: w NOT IN {sql_list(STOP_WORDS)})"


@register(f"SELECT doc_id, CAST(len({_RAW}) AS INTEGER) AS n_words, md5(list_aggregate({_RAW}, 'string_agg', ' ')) AS words_md5 FROM documents")
def raw_token_lists(spark, d):
    """X6d: base forms without stop words, marks and digits kept."""
    w = texts(spark, d).select("doc_id", X.raw_tokens(F.col("text"), STOP_WORDS, LEMMAS).alias("w"))
    return w.select("doc_id", F.size("w").alias("n_words"), F.when(F.size("w") > 0, F.md5(F.array_join("w", " "))).alias("words_md5"))


_PARTS = "regexp_extract_all(text, '[A-Za-z]+|[0-9]+|[.,;:!?]')"


@register(f"""SELECT conv_id, turn, CAST(sum(len(list_filter({_PARTS}, lambda w: regexp_matches(w, '^[a-z]') AND w NOT IN {sql_list(STOP_WORDS)}))) AS BIGINT) AS n_words,
 min(list_aggregate(list_filter({_PARTS}, lambda w: regexp_matches(w, '^[a-z]') AND w NOT IN {sql_list(STOP_WORDS)}), 'string_agg', ' ')) AS words FROM conversations GROUP BY conv_id, turn""")
def tagged_tokens(spark, d):
    """Words by tag, here those that are no names, numbers or marks."""
    w = table(spark, d, "conversations").select("conv_id", "turn", X.words_by_tag(X.tagged(F.col("text")), ("NUM", "PUNCT", "PROPN"), STOP_WORDS).alias("w"))
    return w.groupBy("conv_id", "turn").agg(F.sum(F.size("w")).alias("n_words"), F.min(F.when(F.size("w") > 0, F.array_join("w", " "))).alias("words"))


@register(f"""SELECT item_id, list_aggregate(list_transform(list_filter({_PARTS}, lambda w: regexp_matches(w, '^[A-Z]') OR regexp_matches(w, '^[a-z]') AND w NOT IN {sql_list(STOP_WORDS)}),
 lambda w: CASE WHEN regexp_matches(w, '^[A-Z]') THEN {sql_lower("w")} ELSE {sql_lemma("w")} END), 'string_agg', ' ') AS terms FROM benchmark""")
def match_term_tokens(spark, d):
    """Names as they are, other words in base form."""
    t = X.match_terms(X.tagged(F.col("text")), STOP_WORDS, LEMMAS)
    return table(spark, d, "benchmark").select("item_id", F.nullif(F.array_join(t, " "), F.lit("")).alias("terms"))


@register(f"""WITH c AS (SELECT doc_id, trim(text) = '' AS blank, {SQL_CLEAN} AS cleaned FROM documents)
 SELECT doc_id, CASE WHEN NOT blank THEN cleaned END AS cleaned, CAST(CASE WHEN blank THEN 0 ELSE len({sql_content("cleaned")}) END AS INTEGER) AS n_words FROM c""")
def preprocessed_documents(spark, d):
    """X8, X1."""
    p = texts(spark, d).select("doc_id", X.preprocessed(F.col("text"), CONTRACTIONS, STOP_WORDS, LEMMAS).alias("p"))
    return p.select("doc_id", "p.cleaned", F.col("p.count").alias("n_words"))


_BARE = f"regexp_replace({sql_bare('sentence')}, '^\\s+|\\s+$', '', 'g')"
_ENOUGH = "len(list_filter(regexp_split_to_array(s, '\\s+'), lambda x: x <> '')) >= 5"


@register(f"""WITH {SQL_SENTENCES}, b AS (SELECT doc_id, sent_idx, {_BARE} AS s FROM sent), k AS (SELECT doc_id, sent_idx, CASE WHEN {_ENOUGH} AND NOT {sql_greets("s")} THEN s ELSE '' END AS s FROM b)
 SELECT doc_id, string_agg(CAST(len({sql_content("s")}) AS VARCHAR), ',' ORDER BY sent_idx) AS counts, CAST(sum(length(s)) AS BIGINT) AS n_chars FROM k GROUP BY doc_id""")
def preprocessed_sentences(spark, d):
    """Rejected sentences keep their place."""
    p = texts(spark, d).filter("text is not null").select("doc_id", X.preprocessed_list(X.sentences(F.col("text")), STOP_WORDS, LEMMAS).alias("p"))
    n = F.aggregate("p", F.lit(0).cast("long"), lambda a, x: a + F.length(x["cleaned"]))
    return p.select("doc_id", F.array_join(F.transform("p", lambda x: x["count"].cast("string")), ",").alias("counts"), n.alias("n_chars"))


@register(f"""WITH {SQL_SENTENCES}, b AS (SELECT doc_id, {sql_bare("sentence")} AS s, sentence FROM sent), w AS (SELECT doc_id, s, regexp_replace(s, '^\\s+|\\s+$', '', 'g') AS t, sentence FROM b)
 SELECT doc_id, count(*) FILTER (len(string_split(s, ' ')) >= 5 AND NOT {sql_greets("s")}) AS legacy, count(*) FILTER (len(list_filter(regexp_split_to_array(t, '\\s+'), lambda x: x <> '')) >= 5 AND NOT {sql_greets("t", (*X.GREETINGS, "welcome", "ta"))}) AS strict,
 CAST(sum(length({sql_bare("sentence", X.APOLOGIES)})) AS BIGINT) AS n_chars FROM w GROUP BY doc_id""")
def sentence_filter_variants(spark, d):
    """X4b, X4c, X4d: empty strings counted as words; more words that reject; apologies taken out, nothing rejected."""
    s = texts(spark, d).select("doc_id", F.explode(X.sentences(F.col("text"))).alias("s"))
    legacy, strict = X.kept_sentence(F.col("s"), legacy=True), X.kept_sentence(F.col("s"), rejects=(*X.GREETINGS, "welcome", "ta"))
    return s.groupBy("doc_id").agg(F.count(legacy).alias("legacy"), F.count(strict).alias("strict"), F.sum(F.length(X.without_phrases(F.col("s"), X.APOLOGIES))).alias("n_chars"))


@register(f"""SELECT token, CAST(token IN {sql_list(STOP_WORDS)} AS INTEGER) AS stop, CAST(token IN {sql_list(L.NEGATION)} AS INTEGER) AS negation, count(*) AS n FROM (SELECT unnest({sql_tokens("text")}) AS token FROM documents) GROUP BY token""")
def word_flags(spark, d):
    """X15."""
    t = texts(spark, d).select(F.explode(X.tokens(F.col("text"))).alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    return t.select("token", X.is_one_of(F.col("token"), STOP_WORDS).alias("stop"), X.is_one_of(F.col("token"), L.NEGATION).alias("negation"), "n")


@register("""WITH g AS (SELECT conv_id, list(role ORDER BY turn, text) AS r, list(text ORDER BY turn, text) AS t FROM conversations GROUP BY conv_id)
 SELECT conv_id, CASE WHEN len(list_distinct(r)) = 1 THEN r[1] ELSE array_to_string(r, ',') END AS roles, nullif(trim(array_to_string(t, ' ')), '') AS joined, coalesce(nullif(trim(array_to_string(t, ' ')), ''), 'false') AS legacy FROM g""")
def joined_lists(spark, d):
    """X1, X1b, X17."""
    g = table(spark, d, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "text", "role"))).alias("t"))
    g = g.select("conv_id", F.transform("t", lambda x: x["role"]).alias("r"), F.transform("t", lambda x: x["text"]).alias("t"))
    return g.select("conv_id", F.array_join(X.one_if_all_equal(F.col("r")), ",").alias("roles"), X.joined(F.col("t")).alias("joined"), F.coalesce(X.joined(F.col("t")), F.lit("false")).alias("legacy"))


@register("""SELECT c_custkey, 'Ann Lee,Bob,Cy' AS speakers, CAST(4 AS INTEGER) AS n_turns, c_mktsegment || ' is up?|' || c_name || ' more of it;ok|' || c_custkey AS pairs FROM customer""")
def call_turns(spark, d):
    """Speakers, turns, and questions with their answers, of plain-text calls made from the rows."""
    text = F.concat(F.lit("Ann Lee: "), "c_mktsegment", F.lit(" is up?\nBob: "), "c_name", F.lit("\nmore of it\nAnn Lee: ok\nCy: "), F.col("c_custkey").cast("string"), F.lit("\n"))
    t = table(spark, d, "customer").select("c_custkey", text.alias("text"))
    t = t.withColumn("turns", calls.turns(F.col("text")))
    pairs = calls.questions_and_answers(F.col("turns"), F.array(F.lit("Ann Lee")))
    return t.select("c_custkey", F.array_join(calls.participants(F.col("text")), ",").alias("speakers"), F.size("turns").alias("n_turns"), F.array_join(F.transform(pairs, lambda p: F.concat(p["question"], F.lit("|"), p["answer"])), ";").alias("pairs"))


_W = "w AS (SELECT doc_id, sent_idx, sentence, " + sql_tokens("sentence") + " AS w FROM sent)"


def _n(words):
    return f"len(list_filter(w, lambda x: x IN {sql_list(words)}))"


_NEG = " OR ".join(f"i > {k} AND coalesce(w[i - {k}], '') IN {sql_list(L.NEGATION)}" for k in (1, 2, 3))
_TURNED = f"len(list_filter(range(1, len(w) + 1), lambda i: w[i] IN {sql_list(L.POSITIVE)} AND ({_NEG})))"


@register(f"""WITH {SQL_SENTENCES}, {_W} SELECT doc_id, string_agg(CASE WHEN len(w) > 1 THEN CAST({_n(L.POSITIVE)} - {_TURNED} AS VARCHAR) ELSE '' END, ',' ORDER BY sent_idx) AS positive, string_agg(CASE WHEN len(w) > 1 THEN CAST({_n(L.NEGATIVE)} + {_TURNED} AS VARCHAR) ELSE '' END, ',' ORDER BY sent_idx) AS negative FROM w GROUP BY doc_id""")
def polarity_by_sentence(spark, d):
    """Counts of every sentence, as arrays of the document."""
    s = texts(spark, d).filter("text is not null").select("doc_id", F.transform(F.transform(X.sentences(F.col("text")), X.tokens), lambda w: F.struct(L.polarity(w)["n_positive"].alias("p"), L.polarity(w)["n_negative"].alias("n"))).alias("s"))
    text = lambda k: F.array_join(F.transform("s", lambda x: F.coalesce(x[k].cast("string"), F.lit(""))), ",")
    return s.select("doc_id", text("p").alias("positive"), text("n").alias("negative"))


@register(f"""WITH {SQL_SENTENCES}, t AS (SELECT doc_id, CAST(sent_idx AS INTEGER) AS sent_idx, {sql_tokens("sentence")} AS w, len(list_filter(regexp_split_to_array(sentence, '\\s+'), lambda x: x <> '')) AS raw, MAP {{{_SYL}}} AS m FROM sent)
 SELECT doc_id, sent_idx, CAST(len(list_filter(w, lambda x: {_COMPLEX})) AS INTEGER) AS n_complex, CAST(raw AS INTEGER) AS n_words,
 round(CASE WHEN len(w) > 0 THEN 0.4 * (avg(raw) OVER (PARTITION BY doc_id) + 100 * (len(list_filter(w, lambda x: {_COMPLEX})) / len(w))) END, 9) AS fog FROM t""")
def fog_index_document_average(spark, d):
    """The document's mean of raw words, each sentence's share of complex tokens."""
    raw = lambda s: F.size(F.filter(F.split(s, r"\s+"), lambda x: x != ""))
    s = texts(spark, d).select("doc_id", X.sentences(F.col("text")).alias("s")).withColumn("raw", F.transform("s", raw))
    mean = F.aggregate("raw", F.lit(0), lambda a, x: a + x) / F.size("raw")
    rows = s.withColumn("mean", mean).select("doc_id", "mean", F.posexplode(F.arrays_zip("s", "raw")).alias("sent_idx", "z")).withColumn("w", X.tokens(F.col("z.s")))
    n = F.size(F.filter("w", L.is_complex))
    return rows.select("doc_id", "sent_idx", n.alias("n_complex"), F.col("z.raw").alias("n_words"), F.round(L.fog_of_average(F.col("mean"), n, F.size("w")), 9).alias("fog"))


_PLAIN = sorted({m for _, m, n in topics.DICTIONARY if not n})
_TOPIC_TERMS = {t: [m for u, m, n in topics.DICTIONARY if u == t and not n and len(m.split()) < 3] for t, _, _ in topics.DICTIONARY}
_GRAMS = "list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))"
_PLACE = " || ',' || ".join(f"'{m}=' || len(list_filter(g, lambda x: x = '{m}'))" for m in sorted(_TOPIC_TERMS["PLACE"]))


@register(f"""WITH {SQL_SENTENCES}, {_W}, g AS (SELECT doc_id, sent_idx, sentence, w, {_GRAMS} AS g FROM w)
 SELECT doc_id, CAST(sent_idx AS INTEGER) AS sent_idx, {_PLACE} AS stats, CAST({_n([m for m in _TOPIC_TERMS["PLACE"] if " " not in m])} AS INTEGER) AS uni, CAST(len(list_filter(g, lambda x: x IN {sql_list([m for m in _TOPIC_TERMS["PLACE"] if " " in m])})) AS INTEGER) AS bi,
 CAST(len(w) AS INTEGER) AS len, CAST(len(string_split(sentence, ' ')) AS INTEGER) AS raw_len FROM g""")
def topic_stats_with_zeros(spark, d):
    """M8: every term of a topic with its count in each sentence, 0 included; counts by kind; words and raw words."""
    s = topics.scanned(texts(spark, d)).select("doc_id", F.posexplode(F.arrays_zip("sents", "words", "terms")).alias("sent_idx", "z"))
    stats = topics.full_counts(F.col("z.terms"), _TOPIC_TERMS["PLACE"])
    kind = lambda wanted: F.size(topics.terms_of(F.col("z.terms"), wanted))
    shown = F.array_join(F.transform(F.array_sort(F.map_entries(stats)), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), ",")
    return s.select(
        "doc_id", "sent_idx", shown.alias("stats"), kind([m for m in _TOPIC_TERMS["PLACE"] if " " not in m]).alias("uni"), kind([m for m in _TOPIC_TERMS["PLACE"] if " " in m]).alias("bi"),
        F.size("z.words").alias("len"), F.size(F.split("z.sents", " ")).alias("raw_len"),
    )


_TIME = [m for t, m, n in topics.DICTIONARY if t == "TIME" and not n and len(m.split()) < 3]


@register(f"""WITH {SQL_SENTENCES}, {_W}, c AS (SELECT doc_id, sent_idx, len(w) AS n, len(string_split(sentence, ' ')) AS raw, {", ".join(f"len(list_filter(w, lambda x: x = '{m}')) AS c{k}" for k, m in enumerate(sorted(_TIME)))} FROM w)
 SELECT doc_id, count(*) AS num_sents, string_agg(CAST(n AS VARCHAR), ',' ORDER BY sent_idx) AS len, string_agg(CAST(raw AS VARCHAR), ',' ORDER BY sent_idx) AS raw_len, string_agg(CAST({" + ".join(f"c{k}" for k in range(len(_TIME)))} AS VARCHAR), ',' ORDER BY sent_idx) AS total,
 string_agg({" || '/' || ".join(f"c{k}" for k in range(len(_TIME)))}, ',' ORDER BY sent_idx) AS stats_list, {" || ',' || ".join(f"'{m}=' || CAST(sum(c{k}) AS BIGINT)" for k, m in enumerate(sorted(_TIME)))} AS legacy_stats FROM c GROUP BY doc_id""")
def topic_statistics_full(spark, d):
    """Lists beside the sentences, and the merged counts that keep zeros."""
    s = topics.scanned(texts(spark, d).filter("text is not null"))
    maps = F.transform("terms", lambda t: topics.full_counts(t, _TIME))
    s = s.withColumn("maps", maps)
    listed = lambda a: F.array_join(F.transform(a, lambda x: x.cast("string")), ",")
    sizes = lambda m: F.transform(F.array_sort(F.map_entries(m)), lambda e: e["value"].cast("string"))
    merged = F.transform(F.array_sort(F.map_entries(C.merged_counts_with_zeros(F.col("maps")))), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string")))
    return s.select(
        "doc_id", F.size("sents").cast("long").alias("num_sents"), listed(F.transform("words", F.size)).alias("len"), listed(F.transform("sents", lambda x: F.size(F.split(x, " ")))).alias("raw_len"),
        listed(F.transform("terms", lambda t: F.size(topics.terms_of(t, _TIME)))).alias("total"), F.array_join(F.transform("maps", lambda m: F.array_join(sizes(m), "/")), ",").alias("stats_list"), F.array_join(merged, ",").alias("legacy_stats"),
    )


@register("""SELECT event_id, round(exp(greatest(value, 0) - greatest(value, 0)) * exp(value - greatest(value, 0)) / (exp(0 - greatest(value, 0)) + exp(value - greatest(value, 0))), 9) AS probability FROM events WHERE value IS NOT NULL""")
def logits_to_probability(spark, d):
    """Of the logits (0, value), the second's share."""
    p = C.softmax(F.array(F.lit(0.0), F.col("value")))
    return table(spark, d, "events").filter("value is not null").select("event_id", F.round(p[1], 9).alias("probability"))


@register("""SELECT vec_id, round((((1 + e[1]) / 2) * ((1 + e[2]) / 2)) / (((1 + e[3]) / 2) + 0.000001), 6) AS score FROM (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings)""")
def multiplicative_cosine(spark, d):
    """Two words for, one against, here with a vector's first places as the cosines."""
    at = lambda k: F.col("embedding")[k].cast("double")
    return table(spark, d, "embeddings").select("vec_id", F.round(V.multiplicative_cosine([at(0), at(1)], [at(2)]), 6).alias("score"))


@register("""SELECT p_partkey, CASE WHEN len(w) < 2 THEN array_to_string(w, ' ') ELSE w[1] || '_' || array_to_string(w[2:], ' ') END AS joined FROM (SELECT p_partkey, string_split(p_name, ' ') AS w FROM part)""")
def joined_pairs(spark, d):
    """The first two words of a name are a known pair."""
    w = F.split("p_name", " ")
    known = F.when(F.size(w) > 1, F.array(F.concat_ws("_", w[0], F.get(w, F.lit(1))))).otherwise(F.array().cast("array<string>"))
    return table(spark, d, "part").select("p_partkey", F.array_join(calls.joined_bigrams(w, known), " ").alias("joined"))


_VECTORS = "v AS (SELECT DISTINCT word, [length(word), ascii(word)] AS e FROM (SELECT unnest(string_split(lower(p_name), ' ')) AS word FROM part))"


@register(f"""WITH {_VECTORS}, w AS (SELECT p_partkey, unnest(string_split(lower(p_name), ' ')) AS word FROM part) SELECT p_partkey, round(avg(CAST(e[1] AS DOUBLE)), 9) AS x, round(avg(CAST(e[2] AS DOUBLE)), 9) AS y FROM w JOIN v USING (word) GROUP BY p_partkey""")
def phrase_vectors(spark, d):
    """Phrases without a vector of their own have the mean of their words'."""
    p = table(spark, d, "part")
    words = p.select(F.explode(F.split(F.lower("p_name"), " ")).alias("word")).distinct()
    vectors = words.select("word", F.array(F.length("word").cast("double"), F.ascii("word").cast("double")).alias("vector"))
    out = V.embedded_phrases(p.select(F.col("p_name").alias("phrase")).distinct(), vectors)
    out = p.join(out, F.col("p_name") == F.col("phrase"))
    return out.select("p_partkey", F.round(F.col("vector")[0], 9).alias("x"), F.round(F.col("vector")[1], 9).alias("y"))


@register("""SELECT word, CAST(8 AS INTEGER) AS size, true AS finite FROM (SELECT unnest(string_split(lower(p_name), ' ')) AS word FROM part) GROUP BY word HAVING count(*) >= 10""")
def word2vec_vocabulary(spark, d):
    """Word vectors trained over all names; the twin tells the words that have one, and their size."""
    names = table(spark, d, "part").select(F.split(F.lower("p_name"), " ").alias("words"))
    v = vector_to_array(F.col("vector"))
    vectors = V.train_word2vec(names, "words", size=8, min_count=10, epochs=1).getVectors()
    return vectors.select("word", F.size(v).alias("size"), F.forall(v, lambda x: ~F.isnan(x) & (F.abs(x) < float("inf"))).alias("finite"))


@register("""SELECT doc_id, CAST(length(text) AS DOUBLE) AS x, CAST(len(regexp_extract_all(text, '[aeiou]')) AS DOUBLE) AS y FROM documents""")
def sentence_embeddings(spark, d):
    """An embedding model as a plug-in, loaded once in each worker."""
    e = models.embed(texts(spark, d).select("doc_id", "text"), models.StubEmbedder)
    return e.select("doc_id", F.col("embedding")[0].alias("x"), F.col("embedding")[1].alias("y"))


@register("""WITH g AS (SELECT conv_id, list(text ORDER BY turn, text) AS t FROM conversations GROUP BY conv_id)
 SELECT conv_id, array_to_string(list_transform(t, lambda x: CAST(CAST('0x' || substr(md5(x || '|up'), 1, 7) AS BIGINT) AS VARCHAR)), ',') AS scores FROM g""")
def scores_by_call(spark, d):
    """Texts of a call are laid flat, scored in batches, and put back in order; a call without texts keeps []."""
    g = table(spark, d, "conversations").groupBy("conv_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("turn", "text"))), lambda x: x["text"]).alias("texts"))
    out = models.score_lists(g, "conv_id", "texts", "up")
    return out.select("conv_id", F.array_join(F.transform("scores", lambda s: F.round(s * 16**7).cast("long").cast("string")), ",").alias("scores"))


@register(f"""WITH s AS (SELECT doc_id, {sql_tokens("text")} AS w FROM documents) SELECT doc_id, CAST({_n(("the", "and"))} AS INTEGER) AS md_matches, CAST({_n(("with",))} AS INTEGER) AS qa_matches, CAST(len(w) AS INTEGER) AS n FROM s""")
def section_functions(spark, d):
    """One function for every section, given its words by ``partial``; a struct of two results from one column."""

    def matched(words, text):
        w = X.tokens(text)
        return F.struct(F.size(F.filter(w, lambda x: x.isin(*words))).alias("matches"), F.size(w).alias("n"))

    of_section = {"md": partial(matched, ("the", "and")), "qa": partial(matched, ("with",))}
    rows = texts(spark, d).select("doc_id", *[f(F.col("text")).alias(k) for k, f in of_section.items()])
    return rows.select("doc_id", F.col("md.matches").alias("md_matches"), F.col("qa.matches").alias("qa_matches"), F.col("md.n").alias("n"))


@register("SELECT n_nationkey, length(n_name) AS size FROM nation")
def udf_by_keyword(spark, d):
    """A row-wise function by type keyword, over a small table."""
    return table(spark, d, "nation").select("n_nationkey", models.udf_of(len, "long")(F.col("n_name")).alias("size"))
