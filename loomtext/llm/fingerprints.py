"""Document fingerprints: one-permutation MinHash with optimal densification, packed to low-order bits.

The distinct five-word shingles of a text (lower case, ASCII white space between words) are hashed once. A hash's
high bits name its bin, each bin keeps its smallest hash, and an empty bin takes the value of the first filled bin in
an order of all bins that is fixed for it. Four low-order bits of every bin are stored. Two unlike bins still agree
in one of 16 cases, for which the likeness is corrected.

Everything is built-in array functions within one projection; a text's sketch never leaves its row.

Defined cases: a null text is empty; a text of fewer than five words has its whole word sequence as its one shingle;
one without words has the empty fingerprint, like another such one (1.0) and unlike all others (0.0); repeated ids
are ordered by a hash of their text, then by the text; a table of one row is followed by itself; an empty table gives
an empty result.
"""

from __future__ import annotations

import random

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import documents, order_cuts, order_range

BINS, BIN_BITS, STORED_BITS, SHINGLE = 128, 7, 4, 5
PROBES_FIRST = 16
SPACE = r"[\x20\x09-\x0D]+"
#: Rows to a range of the id order.
RANGE_ROWS = 4096


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once for the row, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words(text: Column) -> Column:
    """Lower-case words, or null where there is none."""
    bare = F.btrim(F.lower(F.coalesce(text, F.lit(""))), F.lit(" \t\n\x0b\f\r"))
    return F.when(bare != "", F.split(bare, SPACE))


def shingle_hashes(text: Column) -> Column:
    def of_words(w: Column) -> Column:
        many = let(F.transform(w, lambda x: F.xxhash64(x)), lambda h: F.transform(F.sequence(F.lit(0), F.size(h) - SHINGLE), lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(SHINGLE)])))
        return F.when(F.size(w) >= SHINGLE, many).when(w.isNotNull(), F.array(F.xxhash64(F.array_join(w, " "))))

    return let(words(text), of_words)


def _probe_orders() -> Column:
    """For every bin, all bins in its own order, one bin after the other in one array."""
    rng, flat = random.Random(5), []
    for _ in range(BINS):
        order = list(range(BINS))
        rng.shuffle(order)
        flat += order
    return F.expr(f"cast(split('{','.join(map(str, flat))}', ',') as array<int>)")


def packed(text: Column) -> Column:
    """Eight longs of 16 four-bit values; null for a text without words."""
    low = 64 - BIN_BITS
    last = (1 << low) - 1
    half = BINS // 2
    ends = F.expr("array(" + ",".join(f"{(b << low) | last}L" for b in range(-half, half)) + ")")
    orders = _probe_orders()

    def empty(v: Column) -> Column:
        return v.bitwiseAND(F.lit(last)) == F.lit(last)

    def bin_minima(h: Column) -> Column:
        # The largest value of each bin is put in, so that every bin has a first element in the sorted hashes.
        same_bin = lambda a, b: F.shiftright(a, low) == F.shiftright(b, low)
        return let(F.sort_array(F.concat(h, ends)), lambda s: F.filter(s, lambda x, i: (i == 0) | ~same_bin(x, F.get(s, i - 1))))

    def densify(v: Column) -> Column:
        def donor(i: Column, at: int, n: int) -> Column:
            return F.get(F.filter(F.slice(orders, i * BINS + 1 + at, F.lit(n)), lambda p: ~empty(F.get(v, p))), F.lit(0))

        # Hashed with the bin, as the stored bits of one value in many bins would agree or not all together.
        fill = lambda i: F.xxhash64(i, F.get(v, F.coalesce(donor(i, 0, PROBES_FIRST), donor(i, PROBES_FIRST, BINS - PROBES_FIRST))))
        return F.transform(v, lambda x, i: F.when(empty(x), fill(i)).otherwise(x))

    def pack(v: Column) -> Column:
        group = lambda g: F.aggregate(F.slice(v, g * 16 + 1, F.lit(16)), F.lit(0).cast("long"), lambda a, x: F.shiftleft(a, STORED_BITS).bitwiseOR(x.bitwiseAND(F.lit(15))))
        return F.transform(F.sequence(F.lit(0), F.lit(BINS // 16 - 1)), group)

    return let(shingle_hashes(text), lambda h: F.when(h.isNotNull(), let(bin_minima(h), lambda v: let(densify(v), pack))))


def fingerprint_text(sketch: Column) -> Column:
    return F.coalesce(F.array_join(F.transform(sketch, lambda x: F.lpad(F.hex(x), 16, "0")), ""), F.lit(""))


def likeness(a: Column, b: Column) -> Column:
    """Estimated share of common shingles, corrected for bins that agree in the stored bits by chance."""
    ones = F.lit(0x1111111111111111)

    def unlike(x: Column, y: Column) -> Column:
        d = x.bitwiseXOR(y)
        any_bit = d.bitwiseOR(F.shiftright(d, 1)).bitwiseOR(F.shiftright(d, 2)).bitwiseOR(F.shiftright(d, 3))
        return F.bit_count(any_bit.bitwiseAND(ones))

    differ = F.aggregate(F.zip_with(a, b, unlike), F.lit(0), lambda s, x: s + x)
    chance = 1.0 / (1 << STORED_BITS)
    corrected = F.greatest(F.lit(0.0), ((1 - differ / BINS) - chance) / (1 - chance))
    return F.when(a.isNull() & b.isNull(), 1.0).when(a.isNull() | b.isNull(), 0.0).otherwise(corrected)


def with_next(df: DataFrame, key: str, carried: dict[str, Column]) -> DataFrame:
    """``df`` and for every column of ``carried`` its value (``x``) and the next row's in key order (``next_x``).

    The order is cut into ranges; only the ranges' first rows are looked up across ranges, and the last row is
    followed by the first.
    """
    cuts = order_cuts(df, key, RANGE_ROWS)
    ids = F.coalesce(F.col(key).cast("long"), F.lit(-(2**63)))
    rows = df.withColumn("order_range", order_range(F.col(key), cuts))
    tie = F.xxhash64(*[F.col(c) for c in df.columns])
    order = [F.col(key).asc_nulls_first(), tie, *[F.col(c) for c in df.columns if c != key]]
    # At most MAX_CUTS + 1 ranges: two numbers and an id for each, so one window over all of them is bounded.
    heads = rows.groupBy(F.col("order_range").alias("head_range")).agg(F.min(ids).alias("head_id"))
    before = F.coalesce(F.lag("head_range").over(Window.orderBy("head_range")), F.max("head_range").over(Window.partitionBy()))
    heads = F.broadcast(heads.withColumn("before_range", before))
    first = rows.join(heads, (F.col("order_range") == F.col("head_range")) & (ids == F.col("head_id")))
    first = first.withColumn("head_rank", F.row_number().over(Window.partitionBy("order_range").orderBy(*order))).filter("head_rank = 1")
    first = first.select("before_range", *[c.alias(f"first_{n}") for n, c in carried.items()])
    within = Window.partitionBy("order_range").orderBy(*order)
    rows = rows.withColumns(carried).withColumn("next_row", F.lead(F.struct(*carried)).over(within))
    rows = rows.join(first, F.col("order_range") == F.col("before_range"), "left")
    pick = {f"next_{n}": F.when(F.col("next_row").isNotNull(), F.col(f"next_row.{n}")).otherwise(F.col(f"first_{n}")) for n in carried}
    return rows.withColumns(pick).select(key, *carried, *pick)


def op5_fingerprints(spark, sf_dir):
    docs = documents(spark, sf_dir).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = with_next(docs, "doc_id", {"text": F.col("text"), "sketch": packed(F.col("text"))})
    n = F.length("text")
    edited = F.concat(F.expr("left(text, length(text) - length(text) div 4)"), F.expr("left(next_text, cast(length(text) div 4 as int))"))
    rows = rows.select("doc_id", n.cast("long").alias("n_chars"), "sketch", "next_sketch", edited.alias("edited"))
    rows = rows.select("doc_id", "n_chars", "sketch", "next_sketch", F.sha2(F.encode("edited", "UTF-8"), 256).alias("edited_sha256"), packed(F.col("edited")).alias("edited_sketch"))
    return rows.select(
        "doc_id", "n_chars", "edited_sha256", fingerprint_text(F.col("sketch")).alias("fingerprint"), fingerprint_text(F.col("edited_sketch")).alias("edited_fingerprint"),
        likeness(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"), likeness(F.col("sketch"), F.col("next_sketch")).alias("near_next"),
    )
