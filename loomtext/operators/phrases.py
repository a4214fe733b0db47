"""Known pairs of words put in place of the words, and vectors of phrases that use them.

The vocabulary of pairs is a table (``a_b`` a row) that is written and counted. Up to MAX_KNOWN pairs it is given to every
task, where words are replaced within their rows and nothing is shuffled; beyond that words and pairs are laid flat and meet
the table in shuffled joins. Either way a long row costs no more than its words do.

What stands for a row: the pairs of neighbours that the vocabulary has, overlapping ones included, after the words that
are left. The first known pair of a row takes both its words away, each later one its second word only; what is taken
away is the word's first standing in the row, wherever the pair stands.

Defined cases: keys tell rows apart and aren't null; a null or empty list of words gives no rows; an empty vocabulary
leaves the words as they are.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import arrow_text as A
from ..functions.text import sentences, tokens
from .dictionaries import Lookup

#: Where pairs are numbered from, past the words of any row.
PAIRS_AT = 1 << 32
#: Most pairs that every task is given, some 80 MB.
MAX_KNOWN = 1 << 22


def replaced(words: pa.Array, row: np.ndarray, known: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Words left and known pairs of each row, in their order, and their rows; ``row`` ascends."""
    pairs, at = list(A.runs(words, row, 2, "_"))[1]
    is_known = pc.is_in(pairs, value_set=known)
    pairs, at = pairs.filter(is_known), at[is_known.to_numpy(zero_copy_only=False)]
    opening = at[np.unique(row[at], return_index=True)[1]]
    coded = words.dictionary_encode("encode")
    word = row * max(1, len(coded.dictionary)) + coded.indices.to_numpy()
    gone, times = np.unique(word[np.concatenate([at + 1, opening])], return_counts=True)
    some = np.flatnonzero(np.isin(word, gone))
    some = some[np.argsort(word[some], kind="stable")]
    _, first, which = np.unique(word[some], return_index=True, return_inverse=True)
    left = np.ones(len(words), bool)
    left[some[np.arange(len(some)) - first[which] < times[which]]] = False
    rows = np.concatenate([row[left], row[at]])
    order = np.argsort(rows, kind="stable")
    return pa.concat_arrays([words.filter(pa.array(left)), pairs]).take(pa.array(order)), rows[order]


def _shared(lookup: Lookup):
    """The pairs of a table, for every task."""
    known = lookup.table.select("term").toArrow()["term"].combine_chunks()
    return lookup.table.sparkSession.sparkContext.broadcast(known)


def substituted(rows: DataFrame, words: str, vocabulary: DataFrame, *keys: str, pair: str = "pair") -> DataFrame:
    """(*keys, at, gram): words left and known pairs of each row, in the order of ``at``."""
    lookup = Lookup(vocabulary, pair, pair)
    if lookup.size > MAX_KNOWN:
        return _substituted_flat(rows, words, lookup, *keys)
    rows, known = rows.select(*keys, F.col(words).alias("words")), _shared(lookup)

    def run(batches):
        for b in batches:
            lists = b.column("words")
            grams, row = replaced(lists.flatten(), pc.list_parent_indices(lists).to_numpy(zero_copy_only=False), known.value)
            at = np.arange(len(row)) - np.searchsorted(row, row)
            yield pa.record_batch([b.column(k).take(pa.array(row)) for k in keys] + [pa.array(at), grams], names=[*keys, "at", "gram"])

    return rows.mapInArrow(run, rows.select(*keys, F.lit(0).cast("long").alias("at"), F.lit("").alias("gram")).schema)


def substituted_sentences(docs: DataFrame, text: str, vocabulary: DataFrame, *keys: str, pair: str = "pair") -> DataFrame:
    """(*keys, sent_idx, grams): words left and known pairs of each sentence with words, in their order, between spaces."""
    lookup = Lookup(vocabulary, pair, pair)
    if lookup.size > MAX_KNOWN:
        rows = docs.select(*keys, F.posexplode(sentences(F.col(text))).alias("sent_idx", "sentence")).select(*keys, "sent_idx", tokens(F.col("sentence")).alias("words"))
        flat = _substituted_flat(rows, "words", lookup, *keys, "sent_idx").groupBy(*keys, "sent_idx").agg(F.array_sort(F.collect_list(F.struct("at", "gram")))["gram"].alias("grams"))
        return flat.select(*keys, "sent_idx", F.array_join("grams", " ").alias("grams"))
    rows, known = docs.select(*keys, text), _shared(lookup)

    def run(batches):
        for b in A.pieces(batches, text):
            words, sent, row, number = A.laid_flat(b.column(text))
            grams, sent = replaced(words, sent, known.value)
            sents, first = np.unique(sent, return_index=True)
            lists = pa.ListArray.from_arrays(pa.array(np.append(first, len(sent)), "int32"), grams)
            own = pa.array(row[sents])
            out = pa.record_batch([b.column(k).take(own) for k in keys] + [pa.array(number[sents]), pc.binary_join(lists, " ")], names=[*keys, "sent_idx", "grams"])
            yield from (out.slice(k, A.BATCH_ROWS) for k in range(0, len(out), A.BATCH_ROWS))

    return rows.mapInArrow(run, rows.select(*keys, F.lit(0).alias("sent_idx"), F.lit("").alias("grams")).schema)


def _substituted_flat(rows: DataFrame, words: str, lookup: Lookup, *keys: str) -> DataFrame:
    """:func:`substituted` by shuffled joins, for a table of any size."""
    rest = F.greatest(F.size(words) - 1, F.lit(0))
    neighbours = F.zip_with(F.slice(words, F.lit(1), rest), F.slice(words, F.lit(2), rest), lambda a, b: F.struct(a.alias("first"), b.alias("second")))
    pairs = rows.select(*keys, F.posexplode(neighbours).alias("pos", "p")).select(*keys, "pos", "p.*").withColumn("term", F.concat_ws("_", "first", "second"))
    known = pairs.join(lookup.table, "term").select(*keys, "pos", "first", "second", "term")
    opening = known.groupBy(*keys).agg(F.min(F.struct("pos", F.col("first").alias("word"))).alias("m")).select(*keys, "m.word")
    gone = known.select(*keys, F.col("second").alias("word")).unionByName(opening).groupBy(*keys, "word").agg(F.count(F.lit(1)).alias("gone"))
    standing = Window.partitionBy(*keys, "word").orderBy("pos")
    each = rows.select(*keys, F.posexplode(words).alias("pos", "word")).withColumn("nth", F.row_number().over(standing))
    left = each.join(gone, [*keys, "word"], "left").filter(F.col("nth") > F.coalesce("gone", F.lit(0)))
    return left.select(*keys, F.col("pos").cast("long").alias("at"), F.col("word").alias("gram")).unionByName(known.select(*keys, (F.col("pos") + F.lit(PAIRS_AT)).alias("at"), F.col("term").alias("gram")))


def embedded(phrases: DataFrame, vectors: DataFrame) -> DataFrame:
    """(phrase, vector) of the distinct phrases, by ``vectors`` (word, vector), whose words with ``_`` are the known pairs.

    A phrase with ``_`` has its own vector; others, and those without one, the mean of what :func:`substituted` leaves of
    them; where that knows no vector either, the phrase's own, or null.
    """
    each = phrases.select("phrase").filter("phrase is not null").distinct()
    grams = substituted(each.select("phrase", F.split(F.lower("phrase"), " ").alias("words")), "words", vectors.filter(F.contains("word", F.lit("_"))).select(F.col("word").alias("pair")), "phrase")
    dims = grams.join(vectors, grams["gram"] == vectors["word"]).select("phrase", F.posexplode("vector").alias("dim", "x"))
    means = dims.groupBy("phrase", "dim").agg(F.avg("x").alias("m")).groupBy("phrase").agg(F.transform(F.array_sort(F.collect_list(F.struct("dim", "m"))), lambda s: s["m"]).alias("mean"))
    own = vectors.select(F.col("word").alias("phrase"), F.col("vector").alias("own"))
    out = each.join(own, "phrase", "left").join(means, "phrase", "left")
    return out.select("phrase", F.coalesce(F.when(F.contains("phrase", F.lit("_")), F.col("own")), F.col("mean"), F.col("own")).alias("vector"))
