"""Uniform shuffle into shards of exact size by a communication matrix.

Rows are written once with their input partition and their place in it; blocks are runs of places in a partition. How
many rows of each block go to each shard is drawn from the multivariate hypergeometric law that a uniform shuffle implies:
a binary tree over the blocks halves the shards' sizes level by level, each split being exact hypergeometric draws (their
probabilities are summed outwards from the mode). Rows are permuted within their block by a random number of that place,
the permuted run is cut by the drawn counts, and each shard is permuted again, in ranges of a random key whose counts give
every range its first slot. All of this is done on places alone; texts cross the network once, when rows meet their slots.

Everything is SQL expressions; no task holds more than a block, a range or one node of the tree.

Defined cases: null texts and ids are rows like others; repeated rows are kept and shuffled each for itself, as what
tells rows apart is their place; an empty table gives an empty result; sizes differ by one at most (the first
``n % shards`` shards are the larger ones).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import documents, fresh_name, materialize, uniform, utf8_crc32

#: Rows to a block (a power of two), and to a range of a shard on average.
BLOCK_ROWS = 4096

#: Value of a hypergeometric variable: of ``n`` drawn from ``pop``, of which ``good`` are marked, for a uniform ``u``.
#: Weights relative to the mode's, up and down by the ratio of neighbours; beyond ``reach`` they are under 1e-15.
_RATIO_UP = "({w} * (good - {k}) * (n - {k}) / (({k} + 1D) * (pop - good - n + {k} + 1D)))"
_RATIO_DOWN = "({w} * {k} * (pop - good - n + {k}) / ((good - {k} + 1D) * (n - {k} + 1D)))"


def _draw(pop: str, good: str, n: str, u: str) -> str:
    """SQL for an exact hypergeometric draw; the arguments are SQL over the enclosing scope."""
    up, down = _RATIO_UP.format(w="a.w", k="k"), _RATIO_DOWN.format(w="a.w", k="k")
    total_up = f"aggregate(ups, named_struct('w', 1D, 's', 1D), (a, k) -> named_struct('w', {up}, 's', a.s + {up}), a -> a.s)"
    total_down = f"aggregate(downs, named_struct('w', 1D, 's', 0D), (a, k) -> named_struct('w', {down}, 's', a.s + {down}), a -> a.s)"
    # From the mode upwards, then downwards: the first value at which the running sum passes u * total.
    step = "named_struct('w', {r}, 's', a.s + {r}, 'at', if(a.at is null and a.s + {r} > goal, {v}, a.at))"
    find_up = f"aggregate(ups, named_struct('w', 1D, 's', 1D, 'at', if(1D > goal, mode, cast(null as bigint))), (a, k) -> {step.format(r=up, v='k + 1')})"
    find_down = f"aggregate(downs, named_struct('w', 1D, 's', f.s, 'at', f.at), (a, k) -> {step.format(r=down, v='k - 1')}, a -> coalesce(a.at, mode))"

    def let(name: str, value: str, body: str) -> str:
        return f"get(transform(array({value}), {name} -> {body}), 0)"

    body = let("f", find_up, find_down)
    body = let("goal", f"u * ({total_up} + {total_down})", body)
    body = let("downs", "if(mode > low, sequence(mode, greatest(low + 1, mode - reach), -1L), array())", body)
    body = let("ups", "if(mode < high, sequence(mode, least(high - 1, mode + reach)), array())", body)
    body = let("reach", "cast(10 + 8.5D * sqrt(n * (good / pop) * (1 - good / pop) * ((pop - n) / greatest(pop - 1D, 1D))) as bigint)", body)
    body = let("mode", "least(high, greatest(low, cast(floor((n + 1D) * (good + 1D) / (pop + 2D)) as bigint)))", body)
    body = let("high", "least(n, good)", let("low", "greatest(0L, n - (pop - good))", body))
    for name, value in (("u", u), ("n", n), ("good", good), ("pop", pop)):
        body = let(name, value, body)
    return f"if({good} = 0 or {n} = 0, 0L, if({n} = {pop}, {good}, {body}))"


def communication_matrix(blocks: DataFrame, shards: int, levels: int, seed: int) -> DataFrame:
    """(block, counts): rows that each block sends to each shard. ``blocks``: (block, n), block in [0, 2**levels)."""
    sizes = {levels: blocks}
    for level in range(levels - 1, -1, -1):
        up = sizes[level + 1].groupBy(F.shiftright("block", 1).alias("block")).agg(F.sum("n").alias("n"))
        sizes[level] = up
    first = F.expr(f"transform(sequence(0, {shards - 1}), s -> n div {shards} + if(s < n % {shards}, 1L, 0L))")
    nodes = sizes[0].select("block", "n", first.alias("counts"))
    for level in range(1, levels + 1):
        left = sizes[level].filter("block % 2 = 0").select(F.shiftright("block", 1).alias("parent"), F.col("n").alias("n_left"))
        nodes = nodes.join(left, nodes["block"] == left["parent"], "left").select("block", "n", "counts", F.coalesce("n_left", F.lit(0)).alias("n_left"))
        u = f"shiftrightunsigned(xxhash64({seed}, {level}, block, s), 11) / 9007199254740992D"
        draw = _draw("acc.pop", "counts[s]", "acc.n", u)
        walk = f"""aggregate(sequence(0, {shards - 1}), named_struct('pop', n, 'n', n_left, 'out', cast(array() as array<bigint>)),
            (acc, s) -> get(transform(array({draw}), x -> named_struct('pop', acc.pop - counts[s], 'n', acc.n - x, 'out', array_append(acc.out, x))), 0),
            acc -> acc.out)"""
        nodes = nodes.withColumn("left", F.expr(walk))
        halves = F.expr("""array(named_struct('block', block * 2, 'n', n_left, 'counts', left),
            named_struct('block', block * 2 + 1, 'n', n - n_left, 'counts', zip_with(counts, left, (a, b) -> a - b)))""")
        nodes = nodes.select(F.explode(halves).alias("h")).select("h.*").filter("n > 0")
    return nodes.select("block", "counts")


def shard_rows(df: DataFrame, shards: int, seed: int = 17) -> DataFrame:
    """``df`` with ``shard`` and ``slot`` (gapless from 0 in each shard): a uniform shuffle, sizes at most one apart.

    Columns of ``df`` that have these two names are replaced.
    """
    columns = [c for c in df.columns if c.lower() not in ("shard", "slot")]
    row = fresh_name(df, "shard_row")
    rows = materialize(df.select(*columns, F.monotonically_increasing_id().alias(row)), "shard-rows")
    ids = rows.select(F.col(row).alias("row"), F.shiftright(row, 33).alias("part"), F.shiftright(F.col(row).bitwiseAND((1 << 33) - 1), BLOCK_ROWS.bit_length() - 1).alias("chunk"))
    n, parts, chunks = ids.agg(F.count(F.lit(1)), F.max("part") + 1, F.max("chunk") + 1).first()
    levels = ((parts or 1) * (chunks or 1) - 1).bit_length()
    ranges = max(1, -(-n // (shards * BLOCK_ROWS)))
    ids = ids.select("row", (F.col("part") * (chunks or 1) + F.col("chunk")).alias("block"))
    matrix = communication_matrix(ids.groupBy("block").agg(F.count(F.lit(1)).alias("n")), shards, levels, seed + 1)
    # Cut points of the permuted block: a row of rank r goes to the first shard whose running count is over r.
    cuts = F.expr("aggregate(counts, cast(array() as array<bigint>), (a, c) -> array_append(a, c + coalesce(try_element_at(a, -1), 0L)))")
    matrix = materialize(matrix.select("block", cuts.alias("cuts")), "shard-matrix")
    within = Window.partitionBy("block").orderBy(uniform(seed + 2, F.col("row")), "row")
    placed = ids.withColumn("rank", F.row_number().over(within) - 1).join(matrix, "block")
    bits = shards.bit_length()
    steps = F.expr("array(" + ",".join(str(1 << b) for b in reversed(range(bits))) + ")")
    found = F.aggregate(steps, F.lit(0), lambda a, p: F.when((a + p <= shards) & (F.get(F.col("cuts"), a + p - 1) <= F.col("rank")), a + p).otherwise(a))
    placed = placed.select("row", found.alias("shard"), uniform(seed + 3, F.col("row")).alias("u"))
    placed = placed.withColumn("range", F.floor(F.col("u") * ranges).cast("int"))
    running = Window.partitionBy("r_shard").orderBy("r_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy(F.col("shard").alias("r_shard"), F.col("range").alias("r_range")).agg(F.count(F.lit(1)).alias("range_rows"))
    starts = starts.withColumn("range_start", F.coalesce(F.sum("range_rows").over(running), F.lit(0)))
    again = Window.partitionBy("shard", "range").orderBy("u", "row")
    placed = placed.withColumn("range_rank", F.row_number().over(again) - 1)
    placed = placed.join(starts, (F.col("shard") == F.col("r_shard")) & (F.col("range") == F.col("r_range")))
    placed = placed.select(F.col("row").alias(row), "shard", (F.col("range_start") + F.col("range_rank")).cast("long").alias("slot"))
    return rows.join(placed, row).select(*columns, "shard", "slot")


def op1_sharding(spark, sf_dir):
    out = shard_rows(documents(spark, sf_dir).select("doc_id", "text"), 40)
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 16
    return out.select("doc_id", size.alias("size"), utf8_crc32(F.col("text")).alias("text_crc32"), F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
