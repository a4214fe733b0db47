"""Helpers shared by the corpus operators: shared storage, stable randomness and global order."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Most cut points an order is split at; 65,536 ranges of 100 TB are 1.5 GB each.
MAX_CUTS = 65_536


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``, or where that is unset (tests) an own temporary one."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        at = tempfile.mkdtemp(prefix="loomtext-")
        atexit.register(shutil.rmtree, at, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", at)
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(at)
    full = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(path).toString()
    return re.sub("^file:/+", "file:///", full).rstrip("/")


def delete_path(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def delete_at_end(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    store = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    store.mkdirs(p)
    store.deleteOnExit(p)


def materialize(df: DataFrame, tag: str, codec: str = "zstd") -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage and survives lost executors.

    What :func:`forget` doesn't drop before is deleted when the driver ends, as lazy results may still read it.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex}"
    delete_at_end(spark, path)
    df.write.mode("append").option("compression", codec).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.loomtext_path = path
    return out


def forget(df: DataFrame) -> None:
    """Drop what :func:`materialize` wrote, once nothing reads it any more."""
    delete_path(df.sparkSession, df.loomtext_path)


def uniform(seed: int, *cols: Column) -> Column:
    """A double in [0, 1) that depends on the seed and the columns only."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), *cols), 11) / F.lit(float(1 << 53))


def fresh_name(df: DataFrame, base: str) -> str:
    """``base``, lengthened until ``df`` has no column of that name in any case."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base += "_"
    return base


def utf8_crc32(col: Column) -> Column:
    return F.crc32(F.encode(F.coalesce(col, F.lit("")), "UTF-8"))


def order_cuts(df: DataFrame, key: str, rows_per_range: int) -> list[int]:
    """Approximate quantiles of a long key (a bounded list) that split its order into even ranges."""
    n = df.count()
    parts = min(MAX_CUTS, max(1, -(-n // rows_per_range)))
    if parts == 1:
        return []
    at = [i / parts for i in range(1, parts)]
    cuts = df.agg(F.percentile_approx(F.col(key).cast("long"), at, max(10_000, 8 * parts)).alias("c")).first()["c"]
    return sorted(set(cuts or []))


def order_range(key: Column, cuts: list[int]) -> Column:
    """Number of cuts below the key, by binary search; a null key is in range 0, where it sorts first."""
    if not cuts:
        return F.lit(0)
    bits = len(cuts).bit_length()
    padded = cuts + [2**63 - 1] * ((1 << bits) - 1 - len(cuts))
    text = ",".join(map(str, padded))
    steps = ",".join(str(1 << b) for b in reversed(range(bits)))
    table = F.expr(f"cast(split('{text}', ',') as array<bigint>)")
    powers = F.expr(f"array({steps})")
    found = F.aggregate(powers, F.lit(0), lambda acc, p: F.when(F.get(table, acc + p - 1) < key, acc + p).otherwise(acc))
    return F.coalesce(found, F.lit(0))
