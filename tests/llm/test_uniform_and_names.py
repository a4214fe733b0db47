"""Repeated rows are shuffled each for itself; stages carry columns that bear names used inside."""

from __future__ import annotations

import re
import shutil
from math import sqrt
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from loomtext import llm
from loomtext.llm.mixing import mix
from loomtext.llm.sharding import shard_rows

pipeline = pytest.importorskip("corpus_pipeline")
MODULES = ("common", "mixing", "packing", "quality", "repeats", "superminhash", "graph", "encoding")


def inner_names() -> list[str]:
    """Every name that a module of the pipeline gives to a column."""
    found = set()
    for m in MODULES:
        code = (Path(llm.__file__).parent / f"{m}.py").read_text()
        found |= set(re.findall(r"""(?:alias|withColumn|F\.col|groupBy|partitionBy)\(["']([a-z_]+)["']""", code))
    return sorted(found)


def test_repeated_rows_are_shuffled_uniformly(spark):
    n, equal, shards = 60_000, 50_000, 40
    df = spark.range(n).select(F.when(F.col("id") < equal, 0).otherwise(F.col("id")).alias("doc_id"), F.lit("x").alias("text"))
    out = shard_rows(df, shards)
    got = out.groupBy("shard").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("doc_id") == 0).alias("k"), F.min("slot"), F.max("slot"), F.count_distinct("slot").alias("d")).collect()
    each = n // shards
    deviation = sqrt(each * (equal / n) * (1 - equal / n) * (n - each) / (n - 1))
    assert len(got) == shards
    for r in got:
        assert (r.n, r["min(slot)"], r["max(slot)"], r.d) == (each, 0, each - 1, each)
        assert abs(r.k - each * equal / n) <= 5 * deviation
    # The spread over shards is that of the law, neither wider nor as even as a dealing in turn.
    spread = sum((r.k - each * equal / n) ** 2 for r in got) / shards
    assert 0.4 * deviation**2 <= spread <= 2 * deviation**2
    # Within a shard, the equal rows stand all over.
    half = out.filter((F.col("doc_id") == 0) & (F.col("slot") < each // 2)).count()
    assert abs(half - equal / 2) <= 5 * sqrt(n) / 2


def test_sharding_keeps_columns_of_inner_names(spark):
    names = ["row", "part", "chunk", "block", "rank", "range", "u", "cuts", "shard_row", "r_shard", "slot", "Shard"]
    df = spark.range(50).select(F.col("id").alias("doc_id"), *[F.concat(F.lit(c), F.col("id")).alias(c) for c in names])
    out = shard_rows(df, 3)
    assert out.columns == ["doc_id", *names[:-2], "shard", "slot"]
    rows = out.collect()
    assert len(rows) == 50 and all(r[c] == f"{c}{r.doc_id}" for r in rows for c in names[:-2])
    assert sorted(r.slot for r in rows if r.shard == 2) == list(range(16))


def test_mixing_keeps_columns_of_inner_names(spark):
    names = ["edge_cell", "edge_rest", "mix_cell", "mix_copy", "mix_size", "mix_source", "row", "key", "order", "cell", "tie", "target", "whole", "extra", "plan_source", "plan_size", "cap", "words"]
    df = spark.range(300).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "a").when(F.col("id") % 3 == 1, "b").alias("source"), (F.col("id") % 7).alias("size"))
    plain = {r.doc_id: (r.mix_target, r.mix_whole, r.mix_extra) for r in mix(df).collect()}
    wide = mix(df.select("*", *[F.concat(F.lit(c), F.col("doc_id")).alias(c) for c in names], F.lit("gone").alias("mix_extra"))).collect()
    assert {r.doc_id: (r.mix_target, r.mix_whole, r.mix_extra) for r in wide} == plain
    assert all(r[c] == f"{c}{r.doc_id}" for r in wide for c in names)


def test_pipeline_with_columns_of_every_inner_name(spark, small, tmp_path):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    extra = [c for c in inner_names() if c not in docs.columns]
    assert len(extra) > 60
    docs.select("*", *[F.lit(f"of {c}").alias(c) for c in extra]).write.parquet(f"{tmp_path}/documents.parquet")
    shutil.copytree(f"{small}/labels.parquet", f"{tmp_path}/labels.parquet")
    plain, wide = docs, spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in pipeline.STAGES[:-1]:
        plain, wide = pipeline.materialize(stage(spark, plain, small), "plain"), pipeline.materialize(stage(spark, wide, str(tmp_path)), "wide")
        order = lambda df: sorted(df.select("doc_id", "text", "source", "n_chars").collect(), key=repr)
        assert order(plain) == order(wide), name
        assert wide.filter(" or ".join(f"`{c}` is distinct from 'of {c}'" for c in extra)).count() == 0, name
    pieces = lambda df, d: sorted(tuple(r)[:5] for r in pipeline.STAGES[-1][1](spark, df, d).collect())
    assert pieces(plain, small) == pieces(wide, str(tmp_path))
