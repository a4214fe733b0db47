"""Queries of rules as they are defined: speakers of transcripts, fog of sections, flags, failing scorers, summaries."""

from __future__ import annotations

import hashlib

from pyspark.sql import functions as F

from ..functions import lexicon as L
from ..functions import scores as C
from ..functions import text as X
from ..operators import models
from ..operators import relational as R
from ..sources import transcripts
from ..sources.io import table
from .base import SQL_SENTENCES, register, sql_lower, sql_tokens
from .textual import _COMPLEX, _SYL, dealt, texts

_SQL_SPOKEN = f"""{SQL_SENTENCES}, s AS (SELECT doc_id, source, lang, CAST(sent_idx AS INTEGER) AS i, array_to_string({sql_tokens("sentence")}, ' ') AS p, count(*) OVER (PARTITION BY doc_id) AS n FROM sent)"""


def _said(name: str, who: str, discussion: bool) -> str:
    return f"coalesce(string_agg(p, '|' ORDER BY i) FILTER (p <> '' AND i * 2 {'<' if discussion else '>='} n AND doc_id % 5 <> 0 AND ({who})), '') AS {name}"


@register(f"""WITH {_SQL_SPOKEN} SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN 'yes' ELSE 'no' END AS error,
 CASE WHEN doc_id % 5 = 0 THEN NULL WHEN doc_id % 3 = 1 THEN 'C-' || doc_id ELSE 'E-' || coalesce(lang, '') END AS company_id, CASE WHEN doc_id % 5 = 0 OR doc_id % 3 = 1 THEN '' ELSE 'Firm ' || lang END AS company_name,
 {_said("ceo_discussion", "i % 4 = 0 AND doc_id % 3 <> 1", True)}, {_said("exec_discussion", "i % 4 = 1 OR i % 4 = 0 AND doc_id % 3 = 1", True)}, {_said("analyst_questions", "i % 4 = 2", False)},
 {_said("ceo_answers", "i % 4 = 0 AND doc_id % 3 <> 1", False)}, {_said("exec_answers", "i % 4 = 1 OR i % 4 = 0 AND doc_id % 3 = 1", False)} FROM s GROUP BY doc_id, lang""")
def transcript_speakers(spark, d):
    """Every document as a transcript of four speakers by turns, one of them no participant; each fifth one is cut off."""
    said = F.transform(X.sentences(F.col("text")), lambda s, i: F.concat(F.lit('<speaker id="p'), (i % 4).cast("string"), F.lit('"><plist><p> '), F.array_join(X.tokens(s), "  "), F.lit("</p></plist></speaker>")))
    n = F.size("said")
    first = F.ceil(n / 2).cast("int")
    section = lambda name, a: F.concat(F.lit(f'<section name="{name}">'), F.array_join(a, ""), F.lit("</section>"))
    person = lambda i, kind, rest: F.concat(F.lit(f'<participant id="p{i}" type="{kind}" '), rest, F.lit(f">Name {i}</participant>"))
    title = F.when(F.col("doc_id") % 3 == 1, "Chair").otherwise("Chief Executive Officer")
    firm = F.concat(F.lit('title="'), title, F.lit('" affiliation="Firm '), F.coalesce("lang", F.lit("")), F.lit('" affiliation_entity="E-'), F.coalesce("lang", F.lit("")), F.lit('" entity="u0"'))
    people = F.concat(person(0, "corprep", firm), person(1, "corprep", F.lit('title="Finance" affiliation="Firm" affiliation_entity="E" entity="u1"')), person(2, "analyst", F.lit('title=""')))
    head = F.concat(F.lit('<transcript id="7" product="CorrectedTranscript"><meta><title>t</title><date>2024-01-02</date><companies><company>C-'), F.col("doc_id").cast("string"), F.lit("</company></companies><participants>"), people, F.lit("</participants></meta>"))
    parts = F.concat(section(transcripts.DISCUSSION, F.slice("said", F.lit(1), first)), section("Q&amp;A", F.slice("said", first + 1, n)))
    whole = F.concat(head, F.lit("<body>"), parts, F.lit("</body></transcript>"))
    rows = texts(spark, d).select("doc_id", "lang", said.alias("said")).select("doc_id", F.when(F.col("doc_id") % 5 == 0, head).otherwise(whole).alias("raw_xml"))
    out = transcripts.parse_speakers(rows)
    lists = [F.array_join(c, "|").alias(c) for c in ("ceo_discussion", "exec_discussion", "analyst_questions", "ceo_answers", "exec_answers")]
    return out.select("doc_id", "error", "company_id", "company_name", *lists)


_RAW = "len(regexp_extract_all({0}, '[^ \\x09-\\x0d]+'))"


@register(f"""WITH t AS (SELECT doc_id, text, {sql_tokens("text")} AS w, MAP {{{_SYL}}} AS m, string_split(text, '. ') AS s FROM documents WHERE text IS NOT NULL),
 k AS (SELECT doc_id, len(w) AS n, len(list_filter(w, lambda x: {_COMPLEX})) AS c, {_RAW.format("text")} AS raw, list_avg(list_transform(s, lambda x: {_RAW.format("x")})) AS mean FROM t)
 SELECT doc_id, CASE WHEN n > 1 THEN 0.4 * (mean + 100 * (c / raw)) END AS fog, CASE WHEN n > 1 THEN c END AS n_complex, CASE WHEN n > 1 THEN mean END AS words_a_sentence, CASE WHEN n > 1 THEN raw END AS n_words FROM k""")
def fog_of_section_by_raw_words(spark, d):
    """M4, M5: raw words, sentences split at a full stop and a space, means over sentences; null for a token or none."""
    t = texts(spark, d).select("doc_id", *[c.alias(k) for k, c in L.fog_of_section(F.col("text")).items()])
    return t.select("doc_id", "fog", F.col("n_complex").cast("long").alias("n_complex"), "words_a_sentence", F.col("n_words").cast("long").alias("n_words"))


_SETS = {"growth": (("with", "this"), ("the the", "of the"), ("tion ",)), "costs": (("was",), ("is a",), ("by at",))}
_SUPPRESS = {"growth": ("not ",), "costs": ("are the",)}


def _sql_flags(label: str) -> str:
    ones, twos, phrases = (list(x) for x in _SETS[label])
    held = " OR ".join(f"contains(low, '{p}')" for p in phrases)
    not_held = " AND ".join(f"NOT contains(low, '{p}')" for p in _SUPPRESS[label])
    return f"string_agg(CASE WHEN (list_has_any(w, {ones}) OR list_has_any(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]), {twos}) OR {held}) AND {not_held} THEN '1' ELSE '0' END, '' ORDER BY sent_idx) AS {label}"


@register(f"""WITH {SQL_SENTENCES}, t AS (SELECT doc_id, sent_idx, {sql_lower("sentence")} AS low, {sql_tokens("sentence")} AS w FROM sent) SELECT doc_id, {_sql_flags("growth")}, {_sql_flags("costs")} FROM t GROUP BY doc_id""")
def binary_flags_by_sentence(spark, d):
    """For each sentence, whether a word, a pair or a phrase of the set stands in it and nothing that suppresses it."""
    s = texts(spark, d).select("doc_id", F.transform(X.sentences(F.col("text")), lambda x: F.struct(X.lower_ascii(x).alias("low"), X.tokens(x).alias("w"))).alias("s"))

    def flags(label):
        return F.array_join(F.transform("s", lambda x: L.match_flag(x["low"], x["w"], *_SETS[label], _SUPPRESS[label]).cast("int").cast("string")), "")

    return s.select("doc_id", *[flags(k).alias(k) for k in _SETS])


@register(f"""WITH t AS (SELECT doc_id, {sql_tokens("text")} AS w FROM documents), g AS (SELECT doc_id, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || '_' || w[i + 1]))) AS gram FROM t)
 SELECT gram, count(*) AS n, count(DISTINCT doc_id) AS docs FROM g GROUP BY gram""")
def words_and_pairs(spark, d):
    """SET9, W9: words and pairs of words in one set, counted in the task before they are shuffled.

    Where each id has one row, a row's distinct grams tell the documents; else they are told by id and gram.
    """
    docs = dealt(texts(spark, d).select("doc_id", "text"))
    rows = docs.select("doc_id", X.tokens(F.col("text")).alias("w"))
    rows = rows.select("doc_id", F.concat("w", F.transform(X.ngrams(F.col("w"), 2), lambda g: F.replace(g, F.lit(" "), F.lit("_")))).alias("both"))
    ids = texts(spark, d).groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows"))
    if ids.filter("rows > 1 or doc_id is null").isEmpty():
        kinds = F.array(F.struct(F.col("both").alias("grams"), F.lit(1).alias("n"), F.lit(0).alias("docs")), F.struct(F.array_distinct("both").alias("grams"), F.lit(0).alias("n"), F.lit(1).alias("docs")))
        each = rows.select(F.explode(kinds).alias("k")).select("k.n", "k.docs", F.explode("k.grams").alias("gram"))
        return each.groupBy("gram").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    each = rows.select("doc_id", F.explode("both").alias("gram")).groupBy("doc_id", "gram").agg(F.count(F.lit(1)).alias("n"))
    return each.groupBy("gram").agg(F.sum("n").alias("n"), F.count("doc_id").alias("docs"))


@register(f"""WITH {SQL_SENTENCES}, t AS (SELECT doc_id, sent_idx, length(sentence) % 3 AS p, length(sentence) % 4 AS u, length(sentence) % 5 AS g FROM sent)
 SELECT doc_id, string_agg(CASE WHEN u >= p AND u >= g THEN 0 WHEN p >= u AND p >= g THEN 1 ELSE -1 END, ',' ORDER BY sent_idx) AS labels FROM t GROUP BY doc_id""")
def argmax_label_neutral_first(spark, d):
    """Of equal scores, the neutral one goes first; the scores are coarse, so that many are equal."""
    s = texts(spark, d).select("doc_id", X.sentences(F.col("text")).alias("s"))
    score = lambda m: F.transform("s", lambda x: (F.length(x) % m).cast("double"))
    s = s.withColumns({"p": score(3), "u": score(4), "g": score(5)})
    return s.select("doc_id", F.array_join(C.argmax_label(F.col("p"), F.col("u"), F.col("g"), ("neu", "pos", "neg")).cast("array<string>"), ",").alias("labels"))


class FailingScorer(models.StubScorer):
    """Fails for every batch with a text whose MD5 starts with 0."""

    def score(self, texts, labels):
        for t in texts:
            if hashlib.md5((t or "").encode()).hexdigest()[0] == "0":
                raise ValueError("bad text")
        return super().score(texts, labels)


_SCORE = "CAST('0x' || substr(md5(text || '|up'), 1, 7) AS BIGINT)"


@register(f"""SELECT conv_id, turn, CASE WHEN substr(md5(text), 1, 1) <> '0' THEN {_SCORE} END AS score, CASE WHEN substr(md5(text), 1, 1) = '0' THEN 'ValueError: bad text' END AS error FROM conversations WHERE text IS NOT NULL""")
def scores_or_errors(spark, d):
    """A scorer that fails for some texts; only those have no score, and they have the failure's text."""
    rows = table(spark, d, "conversations").filter("text is not null").select("conv_id", "turn", "text", F.lit("up").alias("label"))
    out = models.score_or_error(rows, FailingScorer)
    return out.select("conv_id", "turn", F.round(F.col("score") * 16**7).cast("long").alias("score"), "error")


_NUMBERS = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


@register(" UNION ALL ".join(f"SELECT '{c}' AS name, count({c}) AS n, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std, CAST(min({c}) AS DOUBLE) AS lowest, round(quantile_cont(CAST({c} AS DOUBLE), 0.25), 6) AS q25, round(quantile_cont(CAST({c} AS DOUBLE), 0.5), 6) AS q50, round(quantile_cont(CAST({c} AS DOUBLE), 0.75), 6) AS q75, CAST(max({c}) AS DOUBLE) AS highest FROM lineitem" for c in _NUMBERS))
def summary_of_numbers(spark, d):
    """Count, mean, deviation, extremes and quartiles of every number column."""
    s = R.summary(table(spark, d, "lineitem"), _NUMBERS)
    return s.select("name", "n", F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std"), "lowest", *[F.round(q, 6).alias(q) for q in ("q25", "q50", "q75")], "highest")
