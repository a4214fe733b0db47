"""Queries whose dictionaries are tables that Spark derives from the given ones."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.arrow_text import document_counts, sentence_grams
from ..functions.text import tokens
from ..operators import dictionaries as D
from ..sources.io import table
from .base import SQL_SENTENCES, register, sql_lower, sql_tokens
from .textual import texts

#: Terms stand in this many documents; their topic is told by their length.
LEAST, MOST, TOPICS = 3, 60, 20
_SQL_GRAMS = f"""{SQL_SENTENCES}, tok AS (SELECT doc_id, sent_idx, {sql_tokens("sentence")} AS w FROM sent),
 gram AS (SELECT doc_id, sent_idx, unnest(w) AS term FROM tok UNION ALL SELECT doc_id, sent_idx, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM tok)"""
_SQL_TERMS = f"{_SQL_GRAMS}, dict AS (SELECT term, 'T' || length(term) % {TOPICS} AS topic FROM gram GROUP BY term HAVING count(DISTINCT doc_id) BETWEEN {LEAST} AND {MOST})"


def corpus_terms(spark, d):
    """(term, value): words and pairs of words that neither few nor many documents have."""
    each = document_counts(table(spark, d, "documents"), "text", 2)
    return each.filter(F.col("n").between(LEAST, MOST)).select("term", F.concat(F.lit("T"), (F.length("term") % TOPICS).cast("string")).alias("value"))


@register(f"WITH {_SQL_TERMS} SELECT doc_id, CAST(sent_idx AS INTEGER) AS sent_idx, topic, count(*) AS total, count(DISTINCT term) AS n_terms FROM gram JOIN dict USING (term) GROUP BY ALL")
def dictionary_table_topics(spark, d):
    """Topics of a dictionary of thousands of terms that a job derives, matched within the sentence."""
    lookup = D.Lookup(corpus_terms(spark, d))
    return D.totals(sentence_grams(texts(spark, d), "text", "doc_id", longest=2), lookup, "doc_id", "sent_idx")


_SQL_LEXICON = f"""{SQL_SENTENCES}, tok AS (SELECT doc_id, unnest({sql_tokens("sentence")}) AS word FROM sent),
 lexicon AS (SELECT DISTINCT word, CASE length(word) % 3 WHEN 0 THEN 'litigious' WHEN 1 THEN 'complex' ELSE 'uncertain' END AS class FROM (SELECT unnest({sql_tokens("text")}) AS word FROM documents))"""


@register(f"WITH {_SQL_LEXICON} SELECT doc_id, class, count(*) AS n, count(DISTINCT word) AS n_words FROM tok JOIN lexicon USING (word) GROUP BY ALL")
def lexicon_table_counts(spark, d):
    """Word classes by a lexicon as large as the vocabulary."""
    docs = table(spark, d, "documents")
    words = docs.select(F.explode(tokens(F.col("text"))).alias("term")).distinct()
    value = F.element_at(F.array(F.lit("litigious"), F.lit("complex"), F.lit("uncertain")), (F.length("term") % 3 + 1).cast("int"))
    rows = texts(spark, d).select("doc_id", tokens(F.col("text")).alias("words"))
    found = D.hits(rows, "words", D.Lookup(words.select("term", value.alias("value"))), "doc_id")
    return found.groupBy("doc_id", F.col("value").alias("class")).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("n_words"))


_SQL_LEMMAS = f"""v AS (SELECT DISTINCT unnest({sql_tokens("text")}) AS word FROM documents),
 lemmas AS (SELECT word, substr(word, 1, length(word) - 3) AS base FROM v WHERE length(word) > 6 AND word LIKE '%ing')"""


@register(f"""WITH {_SQL_LEMMAS}, w AS (SELECT doc_id, unnest({sql_tokens("text")}) AS word FROM documents)
 SELECT coalesce(base, word) AS base, count(*) AS n, count(DISTINCT word) AS n_forms FROM w LEFT JOIN lemmas USING (word) GROUP BY ALL""")
def lemma_table_counts(spark, d):
    """Words counted by their base form, looked up in a table of forms derived from the vocabulary."""
    docs = table(spark, d, "documents")
    v = docs.select(F.explode(tokens(F.col("text"))).alias("term")).distinct().filter("length(term) > 6 and term like '%ing'")
    lookup = D.Lookup(v.select("term", F.expr("left(term, length(term) - 3)").alias("value")))
    words = docs.select(F.explode(tokens(F.col("text"))).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return D.base_forms(words, "word", lookup).groupBy("base").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("n_forms"))
