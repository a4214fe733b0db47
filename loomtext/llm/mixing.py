"""Mixing sources to target weights by capped water-filling.

Every source asks for its weight's share of the budget and is clamped at ``max_epochs`` times its own size; what
the clamped ones leave is shared among the others by weight until none is above its cap. The fixed point is read
off one sort of the sources by cap/weight. A source's target is then met by whole repetitions of all its documents
and one more of a seeded sample, whose last document is taken in part, so that the words taken are the target
rounded down.

Defined cases: a null text has size 0; null sources are one source, ordered last; empty tables give empty results;
sources without words have target 0; repeated rows are sampled each for itself (ties of the seeded order are broken
by id and then by text).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import documents, materialize

WORD = r"[^\x20\x09-\x0D]+"
#: A source's seeded order has 2 ** CELL_BITS cells. Only the cell in which its sample ends is ever sorted.
CELL_BITS = 14
#: Sources up to which their plan is broadcast (some 100 bytes each); beyond, it is joined by shuffle.
BROADCAST_SOURCES = 50_000
#: Columns that :func:`mix` adds.
MIX_COLUMNS = ("mix_source_size", "mix_target", "mix_whole", "mix_extra")


def count_words(text: Column) -> Column:
    """Number of maximal runs without ASCII white space (a null text: 0)."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def water_fill(sources: DataFrame, weights: tuple[float, ...], max_epochs: float, budget: float = 1.0) -> DataFrame:
    """Add ``weight`` and ``target`` to (source, source_size); ``budget`` is a share of all sizes.

    There is one row per source, so the running sums are over an aggregate, never over documents.
    """
    by_code_point = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    s = sources.withColumn("weight", F.get(cycle, ((F.row_number().over(by_code_point) - 1) % len(weights)).cast("int")))
    s = s.withColumn("cap", F.col("source_size") * F.lit(float(max_epochs)))
    by_level = Window.orderBy((F.col("cap") / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    everything, before = Window.partitionBy(), by_level.rowsBetween(Window.unboundedPreceding, -1)
    s = s.withColumns(
        {
            "level": F.row_number().over(by_level),
            "left": F.sum("source_size").over(everything) * budget - F.coalesce(F.sum("cap").over(before), F.lit(0.0)),
            "weight_left": F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)),
        }
    )
    # Walking up by cap/weight, sources are clamped until one's cap covers its share of what is left.
    covers = F.col("cap") * F.col("weight_left") >= F.col("left") * F.col("weight")
    water = F.min(F.when(covers, F.struct("level", (F.col("left") / F.col("weight_left")).alias("water")))).over(everything)["water"]
    s = s.withColumn("target", F.coalesce(F.least(F.col("cap"), water * F.col("weight")), F.col("cap")))
    return s.select("source", "source_size", "weight", "target")


def plan_sources(df: DataFrame, weights, max_epochs: float, budget: float, seed: int, key: str, source: str, size: str) -> DataFrame:
    """One row per source: target, whole repetitions of all its documents, and where its one more sample ends."""
    cells = df.groupBy(F.col(source).alias("source"), _cell(seed, key).alias("cell")).agg(F.sum(size).alias("words"))
    cells = materialize(cells, "mix-cells")
    fill = water_fill(cells.groupBy("source").agg(F.sum("words").alias("source_size")), weights, max_epochs, budget)
    whole = F.coalesce(F.floor(F.try_divide("target", "source_size")), F.lit(0))
    fill = fill.withColumn("whole", whole).withColumn("extra", F.greatest(F.floor(F.col("target") - F.col("whole") * F.col("source_size")), F.lit(0)))
    running = Window.partitionBy("source").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    c = cells.withColumn("before", F.coalesce(F.sum("words").over(running), F.lit(0))).withColumnRenamed("source", "c_source")
    joined = fill.join(c, F.col("source").eqNullSafe(F.col("c_source")) & (F.col("before") <= F.col("extra")) & (F.col("extra") < F.col("before") + F.col("words")), "left")
    edge = F.min(F.struct("cell", (F.col("extra") - F.col("before")).alias("rest")))
    plan = joined.groupBy("source").agg(*[F.first(c).alias(c) for c in ("source_size", "target", "whole")], edge.alias("edge"))
    return plan.select("source", "source_size", "target", "whole", F.coalesce("edge.cell", F.lit(-1)).alias("edge_cell"), F.coalesce("edge.rest", F.lit(0)).alias("edge_rest"))


def _seeded(seed: int, key: str) -> Column:
    """A number in [0, 2^52) of the seed and the key alone, the same in any engine that has MD5."""
    return F.conv(F.left(F.md5(F.concat(F.lit(f"{seed}|"), F.coalesce(F.col(key).cast("string"), F.lit("")))), F.lit(13)), 16, 10).cast("long")


def _cell(seed: int, key: str) -> Column:
    return F.shiftright(_seeded(seed, key), 52 - CELL_BITS).cast("int")


def mix(df: DataFrame, weights=(5.0, 2.0, 1.0), max_epochs: float = 3.0, budget: float = 1.0, seed: int = 17, key: str = "doc_id", source: str = "source", size: str = "size") -> DataFrame:
    """``df`` with mix_source_size, mix_target, mix_whole (repetitions) and mix_extra (words of one more, 0 to size).

    Columns of ``df`` that have these four names are replaced; all others are kept as they are.
    """
    plan = materialize(plan_sources(df, weights, max_epochs, budget, seed, key, source, size), "mix-plan")
    plan = plan.select("target", "whole", "edge_cell", "edge_rest", F.col("source").alias("plan_source"), F.col("source_size").alias("plan_size"))
    if plan.count() <= BROADCAST_SOURCES:
        plan = F.broadcast(plan)
    # Rows are carried in one struct, so that no column of theirs meets a name used here.
    columns = [c for c in df.columns if c.lower() not in MIX_COLUMNS]
    size_col = F.coalesce(F.col(size), F.lit(0)).cast("long")
    rows = df.select(F.struct(*columns).alias("row"), F.col(source).alias("source"), F.col(key).alias("key"), size_col.alias("size"), _seeded(seed, key).alias("order"), _cell(seed, key).alias("cell"), F.xxhash64(*columns).alias("tie"))
    rows = rows.join(plan, F.col("source").eqNullSafe(F.col("plan_source")), "left")
    inside = rows.filter(F.col("cell") != F.col("edge_cell")).withColumn("extra", F.when(F.col("cell") < F.col("edge_cell"), F.col("size")).otherwise(0))
    order = Window.partitionBy("source").orderBy("order", "key", "tie")
    before = F.coalesce(F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    edge = rows.filter(F.col("cell") == F.col("edge_cell")).withColumn("extra", F.greatest(F.lit(0), F.least("size", F.col("edge_rest") - before)))
    out = inside.unionByName(edge)
    return out.select("row.*", F.col("plan_size").alias("mix_source_size"), F.col("target").alias("mix_target"), F.col("whole").alias("mix_whole"), F.col("extra").cast("long").alias("mix_extra"))


def repeated(mixed: DataFrame, text: str = "text", size: str = "size") -> DataFrame:
    """The mix itself: every document mix_whole times, then once more, cut to mix_extra words where that is less.

    The column ``mix_copy`` numbers a document's repetitions from 0.
    """
    extra = (F.col("mix_extra") > 0).cast("int")
    copies = F.col("mix_whole").cast("int") + extra
    out = mixed.filter(copies > 0).withColumn("mix_copy", F.explode(F.sequence(F.lit(0), copies - 1)))
    part = (F.col("mix_copy") == F.col("mix_whole")) & (F.col("mix_extra") < F.col(size))
    # Words with the white space that follows them; what is before the first word is a part of its own.
    words = F.split(text, r"(?<=[\x20\x09-\x0D])(?=[^\x20\x09-\x0D])")
    lead = F.regexp_like(text, F.lit(r"^[\x20\x09-\x0D]")).cast("int")
    cut = F.array_join(F.slice(words, F.lit(1), (F.col("mix_extra") + lead).cast("int")), "")
    return out.withColumn(text, F.when(part, cut).otherwise(F.col(text)))


def op10_mixing(spark, sf_dir):
    docs = documents(spark, sf_dir).select("doc_id", "source", count_words(F.col("text")).alias("size"))
    m = mix(materialize(docs, "mix-sizes"))
    taken = F.col("mix_whole") * F.col("size") + F.col("mix_extra")
    return m.select("doc_id", "size", F.col("mix_source_size").alias("source_size"), F.col("mix_target").alias("target"), taken.cast("long").alias("taken"))
