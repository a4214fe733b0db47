"""Filter interaction audit: what each filter removes in every order, from the multilinear extension of the removals.

One scan gives every document the mask of the filters it fails; counts by part and mask are all that leaves it. Of them
each part gets a polynomial: with filter i applied to the extent x_i, a document of mask m is removed to the extent
``1 - prod(1 - x_i for i in m)``. The polynomial is multilinear, so its values at the corners of the cube are the
removals of whole sets of filters, and the integral of a partial derivative along the diagonal, in exact rationals, is
the filter's Shapley value; 120 times that is its removals summed over all orders.

Defined cases: a null text is the empty text; a null or empty source is the part of the empty string; equal texts are
told by SHA-256; a document without an id is never a copy, repeated rows of one id aren't copies of one another; a
document has a label if any of its label rows says so; no documents give no rows; further columns are ignored.
"""

from __future__ import annotations

from fractions import Fraction
from itertools import combinations, permutations
from math import factorial

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import documents

FILTERS = "ABCDE"
MEASURES = ("documents", "good", "toxic")
ORDERS = factorial(len(FILTERS))
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

#: Coefficients by the set of variables of their term.
Polynomial = dict[int, int]


def removal_polynomial(counts: dict[int, int]) -> Polynomial:
    """Removed documents as a function of the filters' extents, from counts of documents by mask."""
    terms: Polynomial = {}
    for mask, n in counts.items():
        bits = [1 << i for i in range(len(FILTERS)) if mask >> i & 1]
        for k in range(1, len(bits) + 1):
            for some in combinations(bits, k):
                terms[sum(some)] = terms.get(sum(some), 0) + (n if k % 2 else -n)
    return terms


def corner(terms: Polynomial, applied: int) -> int:
    """The polynomial's value where the filters of ``applied`` are 1 and the others 0."""
    return sum(c for term, c in terms.items() if term & applied == term)


def shapley(terms: Polynomial, bit: int) -> Fraction:
    """Integral over t in [0, 1] of the partial derivative by one variable at (t, ..., t): a term of degree d gives c / d."""
    return sum((Fraction(c, term.bit_count()) for term, c in terms.items() if term & bit), Fraction(0))


def audit_part(part: str, counts: dict[str, dict[int, int]]) -> list[dict]:
    """The rows of one part, for all orders and steps."""
    removed = {m: removal_polynomial(counts[m]) for m in MEASURES}
    at = {m: [corner(removed[m], applied) for applied in range(1 << len(FILTERS))] for m in MEASURES}
    total = sum(counts["documents"].values())
    bits = {f: 1 << i for i, f in enumerate(FILTERS)}
    summed = {f: shapley(removed["documents"], b) * ORDERS for f, b in bits.items()}
    rows = []
    for order in permutations(FILTERS):
        before = 0
        for step, f in enumerate(order, 1):
            after = before | bits[f]
            here = {m: at[m][after] - at[m][before] for m in MEASURES}
            rows.append({
                "part": part, "filter_order": "".join(order), "step": step, "kept": total - at["documents"][after], "removed": here["documents"],
                "redundant": at["documents"][bits[f]] - here["documents"], "unique_fails": counts["documents"].get(bits[f], 0),
                "good_lost": here["good"], "toxic_lost": here["toxic"], "shapley": int(summed[f]),
            })
            before = after
    return rows


OUT = pa.schema([("part", pa.string()), ("filter_order", pa.string()), ("step", pa.int32()), *[(c, pa.int64()) for c in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")]])


def _audit(batches):
    for batch in batches:
        for row in batch.to_pylist():
            counts = {m: {k: n for k, n in enumerate(row[m]) if n} for m in MEASURES}
            yield pa.RecordBatch.from_pylist(audit_part(row["part"], counts), OUT)


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.translate(text, "\t\n\x0b\x0c\r", " " * 5), " "), "")


def failures(docs: DataFrame) -> DataFrame:
    """(doc_id, part, mask) for every row of ``docs``; bit i of the mask is that the i-th filter fails."""
    text = F.coalesce(F.col("text"), F.lit(""))
    words = F.transform(F.array(words_of(text)), lambda w: F.struct(F.size(w).alias("n"), F.size(F.array_distinct(w)).alias("different")))[0]
    base = docs.select("doc_id", F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"), text.alias("text"))
    base = base.select(
        "doc_id", "part", F.sha2("text", 256).alias("digest"), words.alias("words"), F.length("text").alias("n_chars"),
        (F.length("text") - F.length(F.translate("text", CAPITALS, ""))).alias("capitals"), F.col("text").rlike("[#$%&*|]").alias("marked"),
    )
    tests = [F.col("words.n") < 200, 100 * F.col("words.different") < 50 * F.col("words.n"), 100 * F.col("capitals") > 2 * F.col("n_chars"), F.col("marked")]
    mask = sum((F.when(t, 1 << i).otherwise(0) for i, t in enumerate(tests)), F.lit(0))
    thin = base.select("doc_id", "part", "digest", mask.alias("mask"))
    # Only the least id of a text is no copy, so ids are part of the key and no text is a hot key.
    first = thin.groupBy("digest").agg(F.min("doc_id").alias("i")).select(F.col("digest").alias("g"), "i")
    marked = thin.join(first, (F.col("doc_id") == F.col("i")) & (F.col("digest") == F.col("g")), "left")
    copy = F.col("doc_id").isNotNull() & F.col("i").isNull()
    return marked.select("doc_id", "part", (F.col("mask") + F.when(copy, 16).otherwise(0)).alias("mask"))


def audit(failed: DataFrame, labels: DataFrame) -> DataFrame:
    """All orders and steps of every part of ``failed`` (doc_id, part, mask)."""
    known = labels.filter("doc_id is not null").groupBy(F.col("doc_id").alias("i")).agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    rows = failed.join(known, F.col("doc_id") == F.col("i"), "left")
    amounts = {"documents": F.lit(1), "good": F.col("good"), "toxic": F.col("toxic")}
    cells = rows.groupBy("part", "mask").agg(*[F.coalesce(F.sum(a), F.lit(0)).alias(m) for m, a in amounts.items()])
    size = 1 << len(FILTERS)
    counts = cells.groupBy("part").agg(*[F.array(*[F.coalesce(F.sum(F.when(F.col("mask") == k, F.col(m))), F.lit(0)) for k in range(size)]).alias(m) for m in MEASURES])
    types = {pa.string(): "string", pa.int32(): "int", pa.int64(): "long"}
    return counts.mapInArrow(_audit, ", ".join(f"{f.name} {types[f.type]}" for f in OUT))


def op13_filter_audit(spark, sf_dir):
    return audit(failures(documents(spark, sf_dir)), spark.read.parquet(f"{sf_dir}/labels.parquet"))
