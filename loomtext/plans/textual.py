"""Queries over text: cleaning, sentences, tokens, lexicon scores."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import lexicon as L
from ..functions import text as X
from ..operators import vectors as V
from ..sources.io import table
from .base import SQL_SENTENCES, register, sql_list, sql_lower, sql_tokens


def texts(spark, d):
    return table(spark, d, "documents")


def sents(spark, d):
    return texts(spark, d).select("doc_id", "source", F.posexplode(X.sentences(F.col("text"))).alias("sent_idx", "sentence"))


#: Bytes of text to a task that counts runs of words, whose number of distinct ones sets the task's memory.
TASK_BYTES = 32 << 20


def dealt(docs):
    """``docs`` (text and any others) in tasks of some TASK_BYTES, where the files are cut into larger ones."""
    parts = -(-(docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // TASK_BYTES)
    return docs.repartition(parts) if parts > docs.rdd.getNumPartitions() else docs


T_TEXT, T_SENT = sql_tokens("text"), sql_tokens("sentence")


@register(f"WITH {SQL_SENTENCES} SELECT doc_id, CAST(sent_idx AS INTEGER) AS sent_idx, sentence FROM sent")
def sentence_split(spark, d):
    """X5."""
    return sents(spark, d).select("doc_id", "sent_idx", "sentence")


def sql_bare(column: str, phrases=X.STOCK_PHRASES) -> str:
    for p in phrases:
        column = f"replace({column}, '{p}', '')"
    return column


def sql_greets(column: str, words=X.GREETINGS) -> str:
    return "(" + " OR ".join(f"contains({sql_lower(column)}, '{g}')" for g in words) + ")"


BARE = f"regexp_replace({sql_bare('sentence')}, '^\\s+|\\s+$', '', 'g')"


@register(f"""WITH {SQL_SENTENCES}, bare AS (SELECT doc_id, {BARE} AS s FROM sent)
 SELECT doc_id, count(*) AS n_kept, CAST(sum(length(s)) AS BIGINT) AS n_chars FROM bare WHERE len(list_filter(regexp_split_to_array(s, '\\s+'), lambda x: x <> '')) >= 5
 AND NOT {sql_greets("s")} GROUP BY doc_id""")
def sentence_filter(spark, d):
    """X4, X5."""
    kept = texts(spark, d).select("doc_id", F.explode(X.kept_sentences(F.col("text"))).alias("s"))
    return kept.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_kept"), F.sum(F.length("s")).alias("n_chars"))


@register(f"""WITH s AS (SELECT conv_id, turn, sentence, length(sentence) % 3 AS label FROM (SELECT conv_id, turn, unnest(string_split(regexp_replace(text, '([.!?])\\s+', '\\1' || chr(1), 'g'), chr(1))) AS sentence FROM conversations))
 SELECT conv_id, turn, count(*) FILTER (NOT suffix(sentence, '?')) AS n_sents, coalesce(CAST(sum(label) FILTER (NOT suffix(sentence, '?')) AS BIGINT), 0) AS label_sum, count(*) FILTER (NOT suffix(sentence, '?') AND label = 1) AS n_positive FROM s GROUP BY conv_id, turn""")
def question_filter_aligned(spark, d):
    """The label goes with its sentence; of what is left, the sentences of label 1."""
    s = table(spark, d, "conversations").select("conv_id", "turn", X.sentences(F.col("text")).alias("s"))
    s = s.withColumn("labels", F.transform("s", lambda x: F.length(x) % 3))
    sents, labels = X.no_questions(F.col("s"), F.col("labels"))
    row = s.select("conv_id", "turn", sents.alias("sents"), labels.alias("kept"), X.positive_statements(F.col("s"), F.col("labels")).alias("positive"))
    total = F.aggregate("kept", F.lit(0).cast("long"), lambda a, v: a + v)
    return row.groupBy("conv_id", "turn").agg(F.sum(F.size("sents")).alias("n_sents"), F.sum(total).alias("label_sum"), F.sum(F.size("positive")).alias("n_positive"))


@register(f"SELECT token, count(*) AS n, count(DISTINCT doc_id) AS docs FROM (SELECT doc_id, unnest({T_TEXT}) AS token FROM documents) GROUP BY token")
def token_counts(spark, d):
    """X6, A24."""
    return texts(spark, d).select("doc_id", F.explode(X.tokens(F.col("text"))).alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("doc_id").alias("docs"))


@register(f"SELECT token, count(*) AS n FROM (SELECT unnest({T_TEXT}) AS token FROM documents) GROUP BY token HAVING count(*) >= 10")
def vocab_min_count(spark, d):
    """A25."""
    return texts(spark, d).select(F.explode(X.tokens(F.col("text"))).alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("n")).filter("n >= 10")


@register(f"""WITH t AS (SELECT doc_id, {T_TEXT} AS w FROM documents) SELECT gram, count(*) AS n FROM
 (SELECT unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS gram FROM t) GROUP BY gram HAVING count(*) >= 3""")
def ngram_counts(spark, d):
    """W9, SET9."""
    return dealt(texts(spark, d).select("text")).select(F.explode(X.ngrams(X.tokens(F.col("text")), 2)).alias("gram")).groupBy("gram").agg(F.count(F.lit(1)).alias("n")).filter("n >= 3")


@register(f"""WITH {SQL_SENTENCES}, t AS (SELECT {T_SENT} AS w FROM sent), u AS (SELECT word, count(*) AS n FROM (SELECT unnest(w) AS word FROM t) GROUP BY word),
 p AS (SELECT first, second, count(*) AS n FROM (SELECT unnest(list_transform(range(1, len(w)), lambda i: {{'first': w[i], 'second': w[i + 1]}}), recursive := true) FROM t) GROUP BY ALL HAVING count(*) >= 3)
 SELECT first, second, p.n, (p.n - 3) * (SELECT count(*) FROM u) / (a.n * b.n) AS score FROM p JOIN u a ON a.word = first JOIN u b ON b.word = second WHERE (p.n - 3) * (SELECT count(*) FROM u) / (a.n * b.n) > 2""")
def bigram_phrases(spark, d):
    """A26."""
    t = texts(spark, d).select(X.tokens_and_ends(F.col("text")).alias("words"))
    return V.bigram_phrases(t, 3, 2.0).select("first", "second", "n", "score")


def _in(words):
    return f"CAST(len(list_filter(w, lambda x: x IN {sql_list(words)})) AS INTEGER)"


@register(f"""SELECT doc_id, len(w)::INTEGER AS n_tokens, {_in(L.LITIGIOUS)} AS n_litigious, {_in(L.COMPLEX)} AS n_complex, {_in(L.UNCERTAIN)} AS n_uncertain, {_in(L.LITIGIOUS)} / nullif(len(w), 0) AS litigious_ratio
 FROM (SELECT doc_id, {T_TEXT} AS w FROM documents)""")
def lm_ratios_section(spark, d):
    """M3, J10."""
    t = texts(spark, d).select("doc_id", X.tokens(F.col("text")).alias("w"))
    counts = L.class_counts(F.col("w"))
    return t.select("doc_id", F.size("w").alias("n_tokens"), *[c.alias(k) for k, c in counts.items()], F.try_divide(counts["n_litigious"], F.size("w")).alias("litigious_ratio"))


@register(f"WITH {SQL_SENTENCES}, t AS (SELECT doc_id, CAST(sent_idx AS INTEGER) AS sent_idx, {T_SENT} AS w FROM sent) SELECT doc_id, sent_idx, {_in(L.LITIGIOUS)} AS n_litigious, {_in(L.COMPLEX)} AS n_complex, {_in(L.UNCERTAIN)} AS n_uncertain FROM t")
def lm_counts_sentence(spark, d):
    """M3b."""
    t = sents(spark, d).withColumn("w", X.tokens(F.col("sentence")))
    return t.select("doc_id", "sent_idx", *[c.alias(k) for k, c in L.class_counts(F.col("w")).items()])


@register(f"""WITH t AS (SELECT doc_id, {T_TEXT} AS w FROM documents),
 k AS (SELECT doc_id, len(w) AS n, len(list_filter(w, lambda x: x IN {sql_list(L.POSITIVE)})) AS p, len(list_filter(w, lambda x: x IN {sql_list(L.NEGATIVE)})) AS g,
 len(list_filter(range(1, len(w) + 1), lambda i: w[i] IN {sql_list(L.POSITIVE)} AND (coalesce(w[i - 1], '') IN {sql_list(L.NEGATION)} AND i > 1 OR coalesce(w[i - 2], '') IN {sql_list(L.NEGATION)} AND i > 2 OR coalesce(w[i - 3], '') IN {sql_list(L.NEGATION)} AND i > 3))) AS turned FROM t)
 SELECT doc_id, n::INTEGER AS n_tokens, (p - turned)::INTEGER AS n_positive, (g + turned)::INTEGER AS n_negative, (p - g - 2 * turned) / n AS polarity, coalesce((p - g - 2 * turned) / nullif(p + g, 0), 0.0) AS polarity_legacy FROM k WHERE n > 1""")
def polarity_negation_window(spark, d):
    """M1, M1c, M2, M6, W8."""
    t = texts(spark, d).select("doc_id", X.tokens(F.col("text")).alias("w"))
    return t.select("doc_id", *[c.alias(k) for k, c in L.polarity(F.col("w")).items()]).filter("n_tokens > 1")


_SYL = ", ".join(f"'{k}': {v}" for k, v in sorted(L.SYLLABLES.items()))
_COMPLEX = f"""coalesce(CASE WHEN suffix(x, 'es') THEN map_extract(m, left(x, -2))[1] WHEN suffix(x, 'ing') THEN map_extract(m, left(x, -3))[1] WHEN suffix(x, 'ed') THEN map_extract(m, left(x, -2))[1] END, map_extract(m, x)[1], 0) > 2"""


@register(f"""WITH {SQL_SENTENCES}, t AS (SELECT doc_id, {T_SENT} AS w, MAP {{{_SYL}}} AS m FROM sent), k AS (SELECT doc_id, len(w) AS n, len(list_filter(w, lambda x: {_COMPLEX})) AS c FROM t)
 SELECT doc_id, CAST(sum(n) AS BIGINT) AS n_words, count(*) AS n_sents, CAST(sum(c) AS BIGINT) AS n_complex, 0.4 * (sum(n) / count(*) + 100 * sum(c) / nullif(sum(n), 0)) AS fog FROM k GROUP BY doc_id""")
def fog_index_section(spark, d):
    """M4, M5."""
    k = sents(spark, d).withColumn("w", X.tokens(F.col("sentence"))).select("doc_id", F.size("w").alias("n"), F.size(F.filter("w", L.is_complex)).alias("c"))
    g = k.groupBy("doc_id").agg(F.sum("n").alias("n_words"), F.count(F.lit(1)).alias("n_sents"), F.sum("c").alias("n_complex"))
    return g.withColumn("fog", L.fog(F.col("n_words"), F.col("n_sents"), F.col("n_complex")))


@register(f"""WITH {SQL_SENTENCES}, t AS (SELECT doc_id, CAST(sent_idx AS INTEGER) AS sent_idx, {T_SENT} AS w, MAP {{{_SYL}}} AS m FROM sent)
 SELECT doc_id, sent_idx, 0.4 * (len(w) / 1 + 100 * len(list_filter(w, lambda x: {_COMPLEX})) / nullif(len(w), 0)) AS fog FROM t""")
def fog_index_sentence(spark, d):
    """M4c."""
    k = sents(spark, d).withColumn("w", X.tokens(F.col("sentence")))
    return k.select("doc_id", "sent_idx", L.fog(F.size("w"), F.lit(1), F.size(F.filter("w", L.is_complex))).alias("fog"))


@register(r"""SELECT doc_id, CAST(len(regexp_extract_all(text, '\$[0-9]+')) AS INTEGER) AS n_dollars, CAST(len(regexp_extract_all(text, '[$]*[0-9]+[.]*[0-9]*')) AS INTEGER) AS n_numbers FROM documents""")
def dollar_number_counts(spark, d):
    """X9, X10."""
    return table(spark, d, "documents").select("doc_id", X.dollar_count(F.col("text")).alias("n_dollars"), X.number_count(F.col("text")).alias("n_numbers"))


@register("""SELECT conv_id, turn, CAST(contains(lower(text), 'ceo') OR contains(lower(text), 'chief executive officer') AS INTEGER) AS ceo, CAST(contains(lower(text), 'earning') AS INTEGER) AS earnings,
 CAST(contains(lower(text), 'acquisition') OR contains(lower(text), 'merger') OR contains(lower(text), 'takeover') AS INTEGER) AS merger,
 CAST(len(string_split(lower(text), ' ')) < 3 OR list_contains(string_split(lower(text), ' '), 'operator') OR list_contains(string_split(lower(text), ' '), 'operator,') AS INTEGER) AS operator_turn FROM conversations""")
def keyword_flags(spark, d):
    """X11, X12, X13, X14."""
    t = F.col("text")
    return table(spark, d, "conversations").select("conv_id", "turn", X.any_contains(t, X.CEO_TITLES).alias("ceo"), X.any_contains(t, X.EARNINGS).alias("earnings"), X.any_contains(t, X.MERGERS).alias("merger"), X.is_operator_turn(t).alias("operator_turn"))


@register(f"SELECT doc_id, translate(text, '{X.ACCENTED}', '{X.PLAIN}') AS plain FROM documents")
def accents_stripped(spark, d):
    """X16."""
    return table(spark, d, "documents").select("doc_id", X.without_accents(F.col("text")).alias("plain"))


@register(r"""WITH s AS (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents), k AS (SELECT doc_id, len(l) AS n, len(list_distinct(l)) AS u FROM s)
 SELECT doc_id, (n - u) * 100 / n AS duplicate_pct, CAST((n - u) * 100 / n > 15 AS INTEGER) AS flagged, CAST(CASE WHEN (n - u) * 100 / n > 15 THEN u ELSE n END AS INTEGER) AS n_kept FROM k""")
def duplicate_sentence_pct(spark, d):
    """SET6, SET7, SET8, over lines."""
    s = table(spark, d, "documents").select("doc_id", F.split("text", "\n").alias("l"))
    pct = X.duplicate_percent(F.col("l"))
    return s.select("doc_id", pct.alias("duplicate_pct"), (pct > 15).cast("int").alias("flagged"), F.size(X.distinct_if_many(F.col("l"))).alias("n_kept"))


@register(r"""SELECT page_id, regexp_extract(html, '<title[^>]*>([^<]*)</title>', 1) AS title, CAST(len(regexp_extract_all(html, '<p[ >]')) AS INTEGER) AS n_paragraphs, CAST(len(regexp_extract_all(html, 'href=')) AS INTEGER) AS n_links FROM pages""")
def page_structure(spark, d):
    """S9 on pages: the same kind of extraction where the markup isn't well-formed."""
    return table(spark, d, "pages").select("page_id", F.regexp_extract("html", "<title[^>]*>([^<]*)</title>", 1).alias("title"), F.regexp_count("html", F.lit("<p[ >]")).alias("n_paragraphs"), F.regexp_count("html", F.lit("href=")).alias("n_links"))


@register("""SELECT conv_id, string_agg(text, ' ' ORDER BY turn, text) FILTER (role = 'user') AS questions, count(*) FILTER (role = 'user') AS n_questions FROM conversations GROUP BY conv_id""")
def questions_by_call(spark, d):
    """A22."""
    user = F.when(F.col("role") == "user", F.struct("turn", "text"))
    g = table(spark, d, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(user)).alias("q"))
    return g.select("conv_id", F.when(F.size("q") > 0, F.array_join(F.transform("q", lambda x: x["text"]), " ")).alias("questions"), F.size("q").cast("long").alias("n_questions"))
