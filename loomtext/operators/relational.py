"""Relational building blocks: versions per key, deltas, merges, ranks and declarative pipelines."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .evaluate import ranked


def one_per_key(df: DataFrame, keys: list[str], order: list[Column], ties: str = "first") -> DataFrame:
    """The first row of each key by ``order`` (give it a total order), or with ties='all' every row of that rank."""
    w = Window.partitionBy(*keys).orderBy(*order)
    rank = F.row_number() if ties == "first" else F.rank()
    return df.withColumn("_rank", rank.over(w)).filter("_rank = 1").drop("_rank")


def latest(df: DataFrame, keys: list[str], by: list[str], ties: str = "first") -> DataFrame:
    return one_per_key(df, keys, [F.col(c).desc_nulls_last() for c in by], ties)


def earliest(df: DataFrame, keys: list[str], by: list[str], ties: str = "first") -> DataFrame:
    return one_per_key(df, keys, [F.col(c).asc_nulls_last() for c in by], ties)


def delta(new: DataFrame, history: DataFrame, keys: dict[str, str]) -> DataFrame:
    """Rows of ``new`` without their key in ``history`` (new column: history column); null keys count as new."""
    h = history.select(*[F.col(v).alias(f"_h_{k}") for k, v in keys.items()])
    on = [F.col(k).cast("string") == F.col(f"_h_{k}").cast("string") for k in keys]
    return new.join(h, on, "left_anti")


def merge_insert(history: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """History and those rows of ``new`` whose key it doesn't have; applied twice, it changes nothing more."""
    return history.unionByName(delta(new, history, {k: k for k in keys}))


def in_time(df: DataFrame, event: str, upload: str, days: int = 30) -> DataFrame:
    return df.filter(F.col(upload) <= F.col(event) + F.expr(f"interval {days} days"))


def rank_bucket(rank: Column, *bounds: tuple[str, int], rest: str) -> Column:
    """The name of the first bound that the rank is not over."""
    (name, top), *more = bounds
    out = F.when(rank <= top, name)
    for name, top in more:
        out = out.when(rank <= top, name)
    return out.otherwise(rest)


def members_of(df: DataFrame, chosen: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key is among the chosen: a semi join, no list is collected."""
    return df.join(chosen.select(*keys).distinct(), keys, "left_semi")


def top_distinct(df: DataFrame, entity: str, metric: str, n: int, tie: str) -> DataFrame:
    """The n entities of highest metric, one row each; rows without the metric fall out last of all."""
    best = one_per_key(df, [entity], [F.col(metric).desc_nulls_last(), F.col(tie)])
    return best.orderBy(F.col(metric).desc_nulls_last(), F.col(tie)).limit(n).filter(F.col(metric).isNotNull())


def without_keywords(df: DataFrame, column: str, keywords: Iterable[str]) -> DataFrame:
    """Rows whose column equals none of the keywords; a null stays."""
    return df.filter(~F.coalesce(F.col(column), F.lit("None")).isin(*keywords))


def transformed(df: DataFrame, steps: list[tuple[str, str | list[str], Callable[..., Column]]], missing: str = "raise") -> DataFrame:
    """New columns (name, input or inputs, function of columns) one after the other."""
    for step in steps:
        if not (isinstance(step, tuple) and len(step) == 3):
            raise ValueError("a step is (new column, inputs, function)")
        name, inputs, fn = step
        if not isinstance(name, str) or not callable(fn):
            raise TypeError("a step's name is a string and its function callable")
        inputs = [inputs] if isinstance(inputs, str) else inputs
        if lost := [c for c in inputs if c not in df.columns]:
            if missing == "raise":
                raise ValueError(f"no such columns: {lost}")
            continue
        df = df.withColumn(name, fn(*[F.col(c) for c in inputs]))
    return df


def renamed_by_part(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Columns renamed by the first key that their name contains."""
    return df.toDF(*[next((c.replace(k, v) for k, v in mapping.items() if k in c), c) for c in df.columns])


def without_dots(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.replace(".", "") for c in df.columns])


def columns_like(df: DataFrame, part: str) -> list[str]:
    return [c for c in df.columns if part in c]


def metric_names(labels: Iterable[str], metrics: Iterable[str], sections: Iterable[str]) -> list[str]:
    return [f"{a}_{m}_{s}" for a in labels for m in metrics for s in sections]


def nan_to_null(df: DataFrame) -> DataFrame:
    return df.replace(float("nan"), None)


def parsed_times(df: DataFrame, formats: dict[str, str], suffix: str | None = None) -> DataFrame:
    """Timestamps of string columns by each one's format; unreadable ones are null."""
    if not formats:
        raise ValueError("no columns are given")
    for c in formats:
        if c not in df.columns:
            raise KeyError(c)
    return df.withColumns({c + (suffix or ""): F.try_to_timestamp(F.col(c), F.lit(f)) for c, f in formats.items()})


def profile(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.min(column).alias("lowest"), F.max(column).alias("highest"), F.count(F.lit(1)).alias("n"))


def concatenated(*frames: DataFrame) -> DataFrame:
    first, *rest = frames
    for f in rest:
        first = first.unionByName(f, allowMissingColumns=True)
    return first


def differences(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows that one of the frames has more often than the other."""
    return a.exceptAll(b).withColumn("side", F.lit("left")).unionByName(b.exceptAll(a).withColumn("side", F.lit("right")))


def wide(df: DataFrame, keys: list[str], name: Column, value: str, names: list[str]) -> DataFrame:
    """Long metrics as columns; the names are given, so no job is needed to find them."""
    return df.withColumn("_name", name).groupBy(*keys).pivot("_name", names).agg(F.first(value))


def map_columns(df: DataFrame, column: str, keys: Iterable[str]) -> DataFrame:
    """A map's values as columns, for a known list of keys (no job is run to find them)."""
    return df.withColumns({k: F.try_element_at(F.col(column), F.lit(k)) for k in keys}).drop(column)


def same_columns(a: DataFrame, b: DataFrame) -> bool:
    return set(a.columns) == set(b.columns)


def upsert(history: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``new``, and those of the history whose key it doesn't have."""
    return new.unionByName(delta(history, new, {k: k for k in keys}))


def matching_columns(df: DataFrame, pattern: str) -> list[str]:
    """Columns whose name a regular expression finds a match in."""
    return [c for c in df.columns if re.search(pattern, c)]


def cast_block(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Columns of a fixed schema in one step; what can't be read is null."""
    return df.select(*[F.col(c).try_cast(types[c]).alias(c) if c in types else F.col(c) for c in df.columns])


def shuffled(df: DataFrame, seed: int = 42) -> DataFrame:
    """Rows in an order by a hash of seed and row, the same on every run."""
    return df.orderBy(F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in df.columns])), *df.columns)


def joined_by_surrogate(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """An inner join on a string key by its 64-bit hash, the strings compared only where the hashes meet."""
    left, right = a.withColumn("_k", F.xxhash64(key)), b.withColumnRenamed(key, "_key").withColumn("_k", F.xxhash64("_key"))
    return left.join(right, (left["_k"] == right["_k"]) & (F.col(key) == F.col("_key"))).drop("_k", "_key")


def nan_sum(column: str) -> Column:
    """Sum of what is a number; null where there is none."""
    return F.sum(F.when(~F.isnan(column), F.col(column)))


def summary(df: DataFrame, columns) -> DataFrame:
    """(name, n, mean, std, lowest, q25, q50, q75, highest) of number columns; nulls don't count.

    Quartiles are exact, with linear interpolation: each column's distinct values are counted and ranked in ranges of bounded
    size, so that no task has all of them.
    """
    shares = {"q25": 0.25, "q50": 0.5, "q75": 0.75}

    def of(name: str) -> DataFrame:
        c = F.col(name).cast("double")
        whole = df.agg(F.count(c).alias("n"), F.avg(c).alias("mean"), F.stddev_samp(c).alias("std"), F.min(c).alias("lowest"), F.max(c).alias("highest"))
        counts = df.select(c.alias("_value")).filter("_value is not null").groupBy("_value").agg(F.count(F.lit(1)).alias("_n"))
        # Places, from 0, that a value's rows have in the order of all.
        first = F.col("_rank") - (F.col("_n") + 1) / 2
        placed = ranked(counts, "_value", "_n", "_rank").select("_value", first.alias("_first"), (first + F.col("_n") - 1).alias("_last")).crossJoin(F.broadcast(whole.select("n")))

        def at(place: Column) -> Column:
            return F.max(F.when(place.between(F.col("_first"), F.col("_last")), F.col("_value")))

        place = {q: (F.col("n") - 1) * share for q, share in shares.items()}
        found = placed.agg(*[at(f(p)).alias(f"{q}_{side}") for q, p in place.items() for side, f in (("below", F.floor), ("above", F.ceil))])
        between = {q: F.when(F.ceil(p) == F.floor(p), F.col(f"{q}_below")).otherwise((F.ceil(p) - p) * F.col(f"{q}_below") + (p - F.floor(p)) * F.col(f"{q}_above")) for q, p in place.items()}
        return whole.crossJoin(F.broadcast(found)).select(F.lit(name).alias("name"), "n", "mean", "std", "lowest", *[v.alias(q) for q, v in between.items()], "highest")

    return reduce(DataFrame.unionByName, [of(c) for c in columns])
