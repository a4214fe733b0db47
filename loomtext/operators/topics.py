"""Topic dictionaries and their matches: one pass for all topics, within the document's row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import lower_ascii, sentences, tokens

#: A small dictionary over the synthetic corpus: (topic, term, whether the term suppresses a sentence).
DICTIONARY = [
    ("LINKING", "and", False), ("LINKING", "with", False), ("LINKING", "of the", False), ("LINKING", "was", True),
    ("PLACE", "in", False), ("PLACE", "on", False), ("PLACE", "at", False), ("PLACE", "to the", False), ("PLACE", "is the", True),
    ("TIME", "as", False), ("TIME", "for", False), ("TIME", "the of the", False),
]


def match_set(spark: SparkSession, dictionary=DICTIONARY) -> DataFrame:
    """(topic, term, kind): unigrams, bigrams and longer phrases, and negate."""
    rows = [(t, m, ["unigram", "bigram", "phrase"][min(len(m.split()), 3) - 1], n) for t, m, n in dictionary]
    return spark.createDataFrame(rows, "topic string, term string, kind string, negate boolean")


def terms_in(words: Column, dictionary=DICTIONARY) -> Column:
    """Terms of the dictionary in an array of words: words and pairs as often as they stand there, longer phrases once."""
    plain = [m for _, m, negate in dictionary if not negate]
    parts, grams = [], words
    for n in range(1, max((len(m.split()) for m in plain), default=0) + 1):
        if n > 1:
            grams = F.zip_with(grams, F.slice(words, F.lit(n), F.size(words)), lambda a, b: F.concat(a, F.lit(" "), b))
        some = sorted({m for m in plain if len(m.split()) == n})
        if some:
            found = terms_of(grams, some)
            parts.append(F.array_distinct(found) if n > 2 else found)
    return F.concat(*parts) if parts else F.array().cast("array<string>")


def scanned(docs: DataFrame, dictionary=DICTIONARY, text: str = "text") -> DataFrame:
    """``docs`` with ``sents`` and, beside them, ``terms``: all topics' terms in each, found in one pass within the row."""
    d = docs.withColumn("sents", sentences(F.col(text))).withColumn("words", F.transform("sents", tokens))
    return d.withColumn("terms", F.transform("words", lambda w: terms_in(w, dictionary)))


def topics_of(dictionary, negate: bool = False) -> dict[str, list[str]]:
    out: dict[str, list[str]] = {t: [] for t, _, _ in dictionary}
    for t, m, n in dictionary:
        if n == negate:
            out[t].append(m)
    return out


def terms_of(terms: Column, wanted: list[str]) -> Column:
    return F.filter(terms, lambda x: x.isin(*wanted)) if wanted else F.array().cast("array<string>")


def full_counts(terms: Column, wanted: list[str]) -> Column:
    """A map of every wanted term to its count among ``terms``, 0 included."""
    return F.map_from_arrays(F.array(*[F.lit(m) for m in wanted]), F.array(*[F.size(terms_of(terms, [m])) for m in wanted]))


def sentence_maps(terms: Column, wanted: list[str]) -> Column:
    """For each sentence a map of a topic's terms that stand in it to their counts."""

    def counted(found: Column) -> Column:
        return F.map_from_entries(F.transform(F.array_distinct(found), lambda x: F.struct(x, F.size(F.filter(found, lambda y: y == x)))))

    return F.transform(terms, lambda t: counted(terms_of(t, wanted)))


def topic_totals(docs: DataFrame, dictionary=DICTIONARY, suppress: bool = False) -> DataFrame:
    """(doc_id, source, n_sents, sent_idx, topic, total, n_terms) of sentences with a match, without a shuffle.

    ``suppress``: a topic's match doesn't count in sentences that hold one of its suppressing terms as a substring.
    """
    rows = scanned(docs, dictionary).select("doc_id", "source", F.size("sents").alias("n_sents"), F.posexplode(F.arrays_zip("sents", "terms")).alias("sent_idx", "z"))
    rows = rows.filter(F.size("z.terms") > 0)
    against = topics_of(dictionary, negate=True)

    def one(topic: str, wanted: list[str]) -> Column:
        found = terms_of(F.col("z.terms"), wanted)
        row = F.struct(F.lit(topic).alias("topic"), F.size(found).cast("long").alias("total"), F.size(F.array_distinct(found)).cast("long").alias("n_terms"))
        held = F.lit(False)
        for t in against[topic] if suppress else ():
            held = held | F.contains(lower_ascii(F.col("z.sents")), F.lit(t))
        return F.when(~held & (F.size(found) > 0), row)

    hits = F.array_compact(F.array(*[one(t, m) for t, m in topics_of(dictionary).items()]))
    return rows.select("doc_id", "source", "n_sents", "sent_idx", F.explode(hits).alias("t")).select("doc_id", "source", "n_sents", "sent_idx", "t.topic", "t.total", "t.n_terms")


def topic_hits(docs: DataFrame, dictionary=DICTIONARY) -> DataFrame:
    """(doc_id, source, n_sents, topic, hits): sentences of each document with a match, counted within the row."""
    d = scanned(docs, dictionary)

    def hits(topic: str, wanted: list[str]) -> Column:
        return F.struct(F.lit(topic).alias("topic"), F.size(F.filter("terms", lambda x: F.size(terms_of(x, wanted)) > 0)).cast("long").alias("hits"))

    each = F.array(*[hits(t, m) for t, m in topics_of(dictionary).items()])
    rows = d.select("doc_id", "source", F.size("sents").cast("long").alias("n_sents"), F.explode(each).alias("t"))
    return rows.select("doc_id", "source", "n_sents", "t.topic", "t.hits").filter("hits > 0")


STATS = ("total", "relevance", "count", "sentiment", "net_sentiment")


def topic_report(docs: DataFrame, dictionary=DICTIONARY, stats=STATS, label=None) -> DataFrame:
    """Selected statistics of each (document, topic) with a match; an unknown statistic is a ValueError.

    ``label``: SQL for a sentence's sentiment label (-1, 0, 1).
    """
    if unknown := set(stats) - set(STATS):
        raise ValueError(f"unknown statistics: {sorted(unknown)}")
    m = topic_totals(docs, dictionary).withColumn("label", F.expr(label or "0"))
    aggs = {
        "total": F.sum("total"), "count": F.count(F.lit(1)), "relevance": F.count(F.lit(1)) / F.first("n_sents"),
        "sentiment": F.avg("label"), "net_sentiment": F.sum("label"),
    }
    return m.groupBy("doc_id", "source", "topic").agg(*[aggs[s].alias(s) for s in stats])
