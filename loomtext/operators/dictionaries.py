"""Dictionaries that are tables: lexicons, lemma tables and topic terms, looked up by hash joins.

A table is written once to the shared folder and counted there, so that what derives it runs once. Up to ``MAX_BROADCAST`` entries it is broadcast, so a word is looked up where it is, in constant
time, and only what the table has is ever shuffled. Beyond that words meet the table in a shuffled join: :func:`hits` counts
them within their rows' partitions first, :func:`totals` leaves out before the shuffle nearly all words that the table lacks,
by a filter of bounded size. Both ways give the same rows, and no entry is a literal of the plan.

Defined cases: null and blank terms are left out; a repeated (term, value) counts once; a null text has no words; an empty
table matches nothing; of several base forms of a word the least is taken.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import ngrams
from ..sources.io import scratch

#: Most entries of a broadcast table: some 100 MB at 400 bytes each with Spark's overhead.
MAX_BROADCAST = 262_144
#: Bits of the filter to an entry, most longs of the filter (64 MB), and longs to a part of it.
FILTER_BITS, MAX_LONGS, PART_LONGS = 12, 1 << 23, 1 << 12


class Lookup:
    """``table`` as distinct (term, value) with a number, and whether its counted size lets it be broadcast."""

    def __init__(self, table: DataFrame, term: str = "term", value: str = "value"):
        entries = table.select(F.col(term).alias("term"), F.col(value).alias("value")).filter("trim(term) <> ''").distinct()
        self.path = scratch(table.sparkSession, "lookup")
        entries = self._written(entries.withColumn("entry", F.monotonically_increasing_id()), "entries")
        self.size = entries.count()
        self.small = self.size <= MAX_BROADCAST
        self.table = F.broadcast(entries) if self.small else entries

    def _written(self, df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{self.path}/{name}")
        return df.sparkSession.read.schema(df.schema).parquet(f"{self.path}/{name}")

    def dealt(self) -> DataFrame:
        """The table as a join should take it: whole, hashed by partition, or sorted where a partition would have over MAX_BROADCAST entries."""
        partitions = int(self.table.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        return self.table if self.small or self.size > partitions * MAX_BROADCAST else self.table.hint("shuffle_hash")

    def likely(self, each: DataFrame) -> DataFrame:
        """Rows of ``each`` (term and others) whose term the table has, and a few others: all bits of its hash are set in the filter."""
        longs = PART_LONGS
        while longs < MAX_LONGS and longs * 64 < self.size * FILTER_BITS:
            longs *= 2
        code = F.xxhash64("term")
        at = code.bitwiseAND(F.lit(longs - 1)).cast("int")
        bit = lambda k: F.expr(f"shiftleft(1L, cast(shiftrightunsigned(xxhash64(term), {64 - 6 * k}) & 63 as int))")
        bits = bit(1).bitwiseOR(bit(2)).bitwiseOR(bit(3))
        spark = each.sparkSession
        every = spark.range(longs).select(F.col("id").cast("int").alias("at"), F.lit(0).cast("long").alias("bits"))
        filled = self.table.select(at.alias("at"), bits.alias("bits")).unionByName(every).groupBy("at").agg(F.bit_or("bits").alias("bits"))
        in_order = lambda name, value: F.transform(F.array_sort(F.collect_list(F.struct(name, value))), lambda s: s[value])
        parts = filled.groupBy(F.floor(F.col("at") / PART_LONGS).cast("int").alias("part")).agg(in_order("at", "bits").alias("longs"))
        whole = self._written(parts.agg(in_order("part", "longs").alias("filter")), f"filter-{uuid.uuid4().hex}")
        got = F.get(F.get("filter", F.shiftright(at, PART_LONGS.bit_length() - 1)), at.bitwiseAND(F.lit(PART_LONGS - 1)))
        return each.crossJoin(F.broadcast(whole)).filter(got.bitwiseAND(bits) == bits).select(*each.columns)


def grams(words: Column, longest: int) -> Column:
    """Words and runs of two to ``longest`` of them."""
    return F.concat(*[ngrams(words, k) for k in range(1, longest + 1)]) if longest > 1 else words


def hits(rows: DataFrame, words: str, lookup: Lookup, *keys: str, longest: int = 1) -> DataFrame:
    """(*keys, term, value, n): entries among the words and runs of up to ``longest`` words of each row, ``n`` times each.

    ``keys`` tell rows apart.
    """
    each = rows.select(*keys, F.explode(grams(F.col(words), longest)).alias("term"))
    if lookup.small:
        return each.join(lookup.table, "term").groupBy(*keys, "term", "value").agg(F.count(F.lit(1)).alias("n"))
    counted = each.groupBy(*keys, "term").agg(F.count(F.lit(1)).alias("n"))
    return counted.join(lookup.table, "term").select(*keys, "term", "value", "n")


def topic_totals(rows: DataFrame, words: str, lookup: Lookup, *keys: str, longest: int = 3) -> DataFrame:
    """(*keys, topic, total, n_terms) of rows with a match; runs of over two words count once a row, shorter ones as often as they stand."""
    return totals(rows.select(*keys, F.explode(grams(F.col(words), longest)).alias("term")), lookup, *keys)


def totals(each: DataFrame, lookup: Lookup, *keys: str) -> DataFrame:
    """:func:`topic_totals` of (*keys, term) for every word and run of words.

    Entries that are found go by their number to their row's partition, where they are counted and then summed.
    """
    found = (each if lookup.small else lookup.likely(each)).join(lookup.dealt(), "term")
    found = found.select(*keys, "value", "entry", (F.size(F.split("term", " ")) > 2).alias("once"))
    if not lookup.small:
        found = found.repartition(*keys)
    counted = found.groupBy(*keys, "value", "entry", "once").agg(F.count(F.lit(1)).alias("n"))
    n = F.when(F.col("once"), F.lit(1)).otherwise(F.col("n"))
    return counted.groupBy(*keys, F.col("value").alias("topic")).agg(F.sum(n).cast("long").alias("total"), F.count(F.lit(1)).alias("n_terms"))


def base_forms(words: DataFrame, word: str, lookup: Lookup, name: str = "base") -> DataFrame:
    """``words`` with each row's word in its base form; one without an entry is its own."""
    least = lookup.table.groupBy("term").agg(F.min("value").alias(name))
    least = F.broadcast(least) if lookup.small else least
    found = words.join(least, words[word] == least["term"], "left").drop("term")
    return found.withColumn(name, F.coalesce(name, word))
