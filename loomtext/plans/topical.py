"""Queries over topics, aligned score arrays and entailment summaries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scores as C
from ..functions.text import sentences, tokens
from ..operators import models, topics
from ..sources.io import table
from .base import SQL_SENTENCES, register, sql_lower, sql_tokens
from .textual import texts

_TERMS = "dict(topic, term, negate) AS (VALUES " + ", ".join(f"('{t}', '{m}', {str(n).lower()})" for t, m, n in topics.DICTIONARY) + ")"
SQL_MATCH = f"""{_TERMS}, {SQL_SENTENCES}, tok AS (SELECT doc_id, source, sent_idx, sentence, {sql_tokens("sentence")} AS w FROM sent),
 gram AS (SELECT doc_id, source, sent_idx, unnest(w) AS term FROM tok UNION ALL SELECT doc_id, source, sent_idx, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM tok
 UNION ALL SELECT doc_id, source, sent_idx, unnest(list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))) FROM tok),
 hit AS (SELECT doc_id, source, sent_idx, topic, term, count(*) AS n FROM gram JOIN dict USING (term) WHERE NOT negate GROUP BY ALL),
 total AS (SELECT doc_id, source, sent_idx, topic, CAST(sum(n) AS BIGINT) AS total, count(*) AS n_terms FROM hit GROUP BY ALL)"""


@register(f"WITH {SQL_MATCH} SELECT doc_id, CAST(sent_idx AS INTEGER) AS sent_idx, topic, total, n_terms FROM total")
def topic_match_sentence(spark, d):
    """M7, M8, M11, J11."""
    return topics.topic_totals(texts(spark, d)).select("doc_id", "sent_idx", "topic", "total", "n_terms")


@register(f"""WITH {SQL_MATCH} SELECT doc_id, CAST(sent_idx AS INTEGER) AS sent_idx, topic, total FROM total t WHERE NOT EXISTS
 (SELECT 1 FROM tok JOIN dict ON negate AND contains({sql_lower('tok.sentence')}, dict.term) WHERE tok.doc_id = t.doc_id AND tok.sent_idx = t.sent_idx AND dict.topic = t.topic)""")
def topic_match_suppressed(spark, d):
    """M9, M9b."""
    return topics.topic_totals(texts(spark, d), suppress=True).select("doc_id", "sent_idx", "topic", "total")


@register(f"""WITH {SQL_MATCH} SELECT doc_id, CAST(max(CAST(topic = 'LINKING' AS INTEGER)) AS INTEGER) AS linking, CAST(max(CAST(topic = 'PLACE' AS INTEGER)) AS INTEGER) AS place, CAST(max(CAST(topic = 'TIME' AS INTEGER)) AS INTEGER) AS "time" FROM total GROUP BY doc_id""")
def binary_topic_flags(spark, d):
    """M10, SET10, P19."""
    m = topics.topic_totals(texts(spark, d))
    return m.groupBy("doc_id").agg(*[F.max((F.col("topic") == t).cast("int")).alias(t.lower()) for t in ("LINKING", "PLACE", "TIME")])


@register(f"""WITH {SQL_MATCH}, size AS (SELECT doc_id, count(*) AS n_sents FROM sent GROUP BY doc_id)
 SELECT doc_id, topic, CAST(sum(total) AS BIGINT) AS total, any_value(n_sents) AS n_sents, count(*) AS count, string_agg(sent_idx || ':' || total, ',' ORDER BY sent_idx) AS totals FROM total JOIN size USING (doc_id) GROUP BY doc_id, topic""")
def topic_statistics(spark, d):
    """M12."""
    t = F.array_sort(F.collect_list(F.struct("sent_idx", "total")))
    g = topics.topic_totals(texts(spark, d)).groupBy("doc_id", "topic").agg(F.sum("total").alias("total"), F.first("n_sents").cast("long").alias("n_sents"), F.count(F.lit(1)).alias("count"), t.alias("t"))
    totals = F.array_join(F.transform("t", lambda x: F.concat(x["sent_idx"].cast("string"), F.lit(":"), x["total"].cast("string"))), ",")
    return g.select("doc_id", "topic", "total", "n_sents", "count", totals.alias("totals"))


@register(f"""WITH {SQL_MATCH}, s AS (SELECT doc_id, topic, term, sum(n) AS n FROM hit GROUP BY ALL) SELECT doc_id, topic, string_agg(term || '=' || n, ',' ORDER BY term) AS stats FROM s GROUP BY doc_id, topic""")
def merge_counts(spark, d):
    """Maps of a sentence's terms, merged over the document."""
    merged = lambda wanted: C.without_nulls(C.merged_counts(topics.sentence_maps(F.col("terms"), wanted)))
    each = F.array(*[F.struct(F.lit(t).alias("topic"), merged(m).alias("merged")) for t, m in topics.topics_of(topics.DICTIONARY).items()])
    g = topics.scanned(texts(spark, d)).select("doc_id", F.explode(each).alias("t")).select("doc_id", "t.topic", "t.merged").filter(~F.map_contains_key("merged", C.NO_MATCH))
    return g.select("doc_id", "topic", F.array_join(F.transform(F.array_sort(F.map_entries("merged")), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), ",").alias("stats"))


@register(f"""WITH {SQL_MATCH}, size AS (SELECT doc_id, source, count(*) AS n_sents FROM sent GROUP BY ALL), rel AS (SELECT size.source, topic, size.doc_id, count(*) AS hits, any_value(n_sents) AS n_sents FROM total JOIN size USING (doc_id) GROUP BY ALL)
 SELECT source, topic, count(*) AS docs, CAST(sum(hits) AS BIGINT) AS hits, CAST(sum(n_sents) AS BIGINT) AS n_sents, sum(hits) / sum(n_sents) AS relevance FROM rel GROUP BY ALL""")
def topic_relevance_by_source(spark, d):
    """The flagship: sentence-level topic relevance, by source."""
    g = topics.topic_hits(texts(spark, d)).groupBy("source", "topic").agg(F.count(F.lit(1)).alias("docs"), F.sum("hits").alias("hits"), F.sum("n_sents").alias("n_sents"))
    return g.withColumn("relevance", F.col("hits") / F.col("n_sents"))


#: Aligned arrays by sentence: counts of "the", labels from lengths.
def scored(spark, d):
    s = texts(spark, d).select("doc_id", sentences(F.col("text")).alias("s"))
    s = s.withColumn("found", F.transform("s", lambda x: F.filter(tokens(x), lambda w: w.isin("and", "with"))))
    return s.withColumns({"counts": F.transform("found", F.size), "weights": F.transform("found", lambda x: F.size(F.array_distinct(x))), "labels": F.transform("s", lambda x: F.length(x) % 3 - 1)})


SQL_SCORED = f"""{SQL_SENTENCES}, sc AS (SELECT doc_id, len(list_filter({sql_tokens("sentence")}, lambda x: x IN ('and', 'with'))) AS c, len(list_distinct(list_filter({sql_tokens("sentence")}, lambda x: x IN ('and', 'with')))) AS w, length(sentence) % 3 - 1 AS l FROM sent)"""


@register(f"""WITH {SQL_SCORED} SELECT doc_id, CAST(sum(c * l) AS DOUBLE) / nullif(count(*) FILTER (c > 0), 0) AS sent_weighted, CAST(sum(l) FILTER (c > 0) AS DOUBLE) / nullif(count(*) FILTER (c > 0), 0) AS sent_plain,
 coalesce(CAST(sum(l) FILTER (c > 0) AS DOUBLE), 0) AS net FROM sc GROUP BY doc_id""")
def sentence_scores(spark, d):
    """M13, M14."""
    c, x = F.col("counts"), F.col("labels")
    return scored(spark, d).select("doc_id", C.sentence_score(c, x).alias("sent_weighted"), C.sentence_score(c, x, False).alias("sent_plain"), C.net_score(c, x).alias("net"))


@register(f"""WITH {SQL_SCORED}, k AS (SELECT doc_id, count(*) FILTER (c > 0) AS r, count(*) AS n, sum(l) FILTER (c > 0) AS net, sum(w * l) AS wnet FROM sc GROUP BY doc_id)
 SELECT doc_id, r / n AS relevance, CAST(net AS DOUBLE) / nullif(r, 0) AS sent, CASE WHEN net <> 0 THEN CAST(net AS DOUBLE) / r * (r / n) END AS sent_rel, CAST(wnet AS DOUBLE) / nullif(r, 0) AS sent_weight,
 CASE WHEN wnet <> 0 THEN CAST(wnet AS DOUBLE) / r * (r / n) END AS sent_weight_rel, coalesce(CAST(net AS DOUBLE), 0) AS net_sent FROM k""")
def relevance_suite(spark, d):
    """M15, M16."""
    return scored(spark, d).select("doc_id", *[v.alias(k) for k, v in C.suite(F.col("counts"), F.col("labels"), F.col("weights")).items()])


@register(f"""WITH {SQL_SCORED} SELECT doc_id, (count(*) FILTER (l = 1) - count(*) FILTER (l = -1)) / count(*) AS sentiment, CAST(count(*) FILTER (l = 1) AS INTEGER) AS n_pos, CAST(count(*) FILTER (l = -1) AS INTEGER) AS n_neg, CAST(count(*) AS INTEGER) AS n_sents FROM sc GROUP BY doc_id""")
def section_sentiment(spark, d):
    """A11, A21, P25."""
    return scored(spark, d).select("doc_id", *[v.alias(k) for k, v in C.section_sentiment(F.col("labels")).items()])


@register(f"""WITH {SQL_SENTENCES}, t AS (SELECT doc_id, sent_idx, (length(sentence) * 37 % 101) / 101.0 AS p, (length(sentence) * 17 % 101) / 101.0 AS u, (length(sentence) * 5 % 101) / 101.0 AS g FROM sent)
 SELECT doc_id, string_agg(CASE WHEN p >= u AND p >= g THEN 1 WHEN u >= g THEN 0 ELSE -1 END, ',' ORDER BY sent_idx) AS labels FROM t GROUP BY doc_id""")
def argmax_label(spark, d):
    """N8, N8b."""
    s = texts(spark, d).select("doc_id", sentences(F.col("text")).alias("s"))
    score = lambda m: F.transform("s", lambda x: (F.length(x) * m % 101) / 101.0)
    s = s.withColumns({"p": score(37), "u": score(17), "g": score(5)})
    return s.select("doc_id", F.array_join(C.argmax_label(F.col("p"), F.col("u"), F.col("g")).cast("array<string>"), ",").alias("labels"))


@register("""WITH k AS (SELECT conv_id, turn, (length(text) * 37 % 101) / 101.0 AS s FROM conversations), g AS (SELECT conv_id, count(*) FILTER (s > 0.5) AS hits, count(*) AS n, string_agg(CAST(s > 0.5 AS INTEGER), ',' ORDER BY turn, s) AS flags FROM k GROUP BY conv_id)
 SELECT conv_id, CAST(hits AS INTEGER) AS nli_count, hits, n, flags FROM g""")
def nli_threshold_summary(spark, d):
    """The share is left as its two counts, as rounding differs between engines."""
    s = (F.length("text") * 37 % 101) / 101.0
    g = table(spark, d, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", s.alias("s")))).alias("t"))
    g = g.withColumn("scores", F.transform("t", lambda x: x["s"]))
    out = C.entailment_summary(F.col("scores"), 0.5)
    return g.select("conv_id", out["nli_count"].alias("nli_count"), out["nli_count"].cast("long").alias("hits"), F.size("scores").cast("long").alias("n"), F.array_join(out["nli_total"].cast("array<string>"), ",").alias("flags"))


@register(f"""WITH {SQL_SCORED}, o AS (SELECT doc_id, sent_idx, sentence, len(list_filter({sql_tokens("sentence")}, lambda x: x IN ('and', 'with'))) AS c FROM sent)
 SELECT doc_id, string_agg(sentence, ' ' ORDER BY sent_idx) AS matched FROM o WHERE c = 1 GROUP BY doc_id""")
def extract_matched(spark, d):
    """N4, N5, P24."""
    m = C.null_if_empty(C.matched(F.col("s"), F.col("counts")))
    return scored(spark, d).select("doc_id", F.array_join(m, " ").alias("matched")).filter("matched is not null")


@register("""SELECT conv_id, coalesce(count(*) FILTER (role = 'user'), 0) + coalesce(count(*) FILTER (role = 'assistant'), 0) AS n_parts, string_agg(text, ' | ' ORDER BY role DESC, turn, text) FILTER (role IN ('user', 'assistant')) AS combined FROM conversations GROUP BY conv_id""")
def combine_sections(spark, d):
    """N9, W4c."""
    pick = lambda r: F.array_sort(F.collect_list(F.when(F.col("role") == r, F.struct("turn", "text"))))
    g = table(spark, d, "conversations").groupBy("conv_id").agg(pick("user").alias("u"), pick("assistant").alias("a"))
    both = C.concatenated(F.transform("u", lambda x: x["text"]), F.transform("a", lambda x: x["text"]), "string")
    return g.select("conv_id", F.size(both).cast("long").alias("n_parts"), F.when(F.size(both) > 0, F.array_join(both, " | ")).alias("combined"))


@register("""WITH p AS (SELECT conv_id, turn, text, label FROM conversations, (VALUES ('strong demand'), ('weak demand')) v(label)) SELECT conv_id, turn, label, md5(text || '|' || label) AS pair_hash FROM p""")
def text_pairs(spark, d):
    """Pairs stay structs."""
    labels = F.array(F.lit("strong demand"), F.lit("weak demand"))
    t = table(spark, d, "conversations").select("conv_id", "turn", F.explode(C.text_pairs(F.array("text"), labels)).alias("p"))
    return t.select("conv_id", "turn", "p.label", F.md5(F.concat("p.text", F.lit("|"), "p.label").cast("binary")).alias("pair_hash"))


@register("""WITH p AS (SELECT conv_id, turn, text, label FROM conversations, (VALUES ('strong demand'), ('weak demand')) v(label))
 SELECT conv_id, turn, label, CAST(('0x' || substr(md5(text || '|' || label), 1, 7)) AS BIGINT) / 268435456.0 AS score FROM p""")
def model_scores(spark, d):
    """The plug-in, with the stub model loaded once a worker."""
    labels = F.array(F.lit("strong demand"), F.lit("weak demand"))
    pairs = table(spark, d, "conversations").select("conv_id", "turn", F.explode(C.text_pairs(F.array("text"), labels)).alias("p")).select("conv_id", "turn", "p.text", "p.label")
    return models.score_pairs(pairs).select("conv_id", "turn", "label", "score")


@register(f"""WITH {SQL_MATCH}, size AS (SELECT doc_id, count(*) AS n_sents FROM sent GROUP BY doc_id) SELECT doc_id, topic, CAST(sum(total) AS BIGINT) AS total, count(*) / any_value(n_sents) AS relevance, count(*) AS count,
 avg(sent_idx % 3 - 1) AS sentiment, CAST(sum(sent_idx % 3 - 1) AS BIGINT) AS net_sentiment FROM total JOIN size USING (doc_id) GROUP BY doc_id, topic""")
def topic_report(spark, d):
    """M17, A13 of its labels."""
    return topics.topic_report(texts(spark, d), label="sent_idx % 3 - 1").drop("source")
