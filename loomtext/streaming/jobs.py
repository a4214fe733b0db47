"""Structured Streaming forms of the incremental jobs."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.relational import delta


def stream_table(spark: SparkSession, folder: str, pattern: str, schema, files_per_trigger: int = 1000) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).option("pathGlobFilter", pattern).parquet(folder)


def watermarked(events: DataFrame, ts: str, lateness: str) -> DataFrame:
    """``events`` with a watermark; a time without zone is taken to be in the session's zone, as watermarks need one."""
    return events.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, lateness)


def deduplicated(events: DataFrame, key: str, ts: str, lateness: str = "30 days") -> DataFrame:
    """Each key once within the allowed lateness."""
    return watermarked(events, ts, lateness).dropDuplicatesWithinWatermark([key])


def windowed(events: DataFrame, ts: str, length: str, slide: str | None, *by: str, lateness: str = "30 days") -> DataFrame:
    w = F.window(ts, length, slide) if slide else F.window(ts, length)
    return watermarked(events, ts, lateness).groupBy(w, *by).agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))


def sessions(events: DataFrame, ts: str, gap: str, user: str, lateness: str = "30 days") -> DataFrame:
    return watermarked(events, ts, lateness).groupBy(F.session_window(ts, gap), user).agg(F.count(F.lit(1)).alias("n"))


def appended(stream: DataFrame, path: str, checkpoint: str):
    """Rows as the stream settles them, written once each."""
    return stream.writeStream.format("parquet").option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start(path)


def report(stream: DataFrame, path: str, checkpoint: str):
    """The whole result after each batch, in a folder of its own; a batch that is run again replaces its own."""

    def put(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return stream.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).outputMode("complete").trigger(availableNow=True).start()


def last_report(spark: SparkSession, path: str) -> DataFrame:
    all_of = spark.read.parquet(path)
    newest = all_of.agg(F.max("batch").alias("newest"))
    return all_of.join(F.broadcast(newest), F.col("batch") == F.col("newest"), "left_semi").drop("batch")  # one row


def split_late(events: DataFrame, path: str, keys: list[str], ts: str, checkpoint: str, lateness: str = "30 days"):
    """New keys in time go to ``path``/main, rows later than the batches before allow to ``path``/late.

    Each batch's parts and its greatest time are folders of its number, so a batch that is run again replaces its own.
    """

    def put(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession

        def before(part: str, schema) -> DataFrame:
            if not exists(spark, f"{path}/{part}"):
                return spark.createDataFrame([], schema)
            return spark.read.option("basePath", f"{path}/{part}").parquet(f"{path}/{part}").filter(F.col("batch") < number).drop("batch")

        mark = before("marks", "mark timestamp_ntz").agg(F.max("mark").alias("mark"))
        dated = batch.withColumn(ts, F.col(ts).cast("timestamp_ntz")).crossJoin(F.broadcast(mark))  # one row
        late = F.coalesce(F.col(ts) < F.col("mark") - F.expr(f"interval {lateness}"), F.lit(False))
        split = dated.withColumn("is_late", late).drop("mark")
        timely = split.filter("not is_late").drop("is_late").dropDuplicates(keys)
        new = delta(timely, before("main", timely.schema), {k: k for k in keys})
        new.write.mode("overwrite").parquet(f"{path}/main/batch={number}")
        split.filter("is_late").drop("is_late").write.mode("overwrite").parquet(f"{path}/late/batch={number}")
        dated.agg(F.max(ts).alias("mark")).write.mode("overwrite").parquet(f"{path}/marks/batch={number}")

    return events.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _intervals(docs: list[tuple[int, int, int]], window_days: int) -> Iterator[tuple[int, int, int]]:
    """(first day, day after the last, flag) of an entity's documents (day, version, flag): valid until the next day with one."""
    latest = {day: flag for day, _, flag in sorted(docs)}
    days = sorted(latest)
    for day, following in zip(days, [*days[1:], None], strict=False):
        end = day + window_days
        yield day, end if following is None else min(end, following), latest[day]


DAY_MS = 86_400_000
#: Keys of the state: entities are dealt out to so many, as a call for every entity costs more than its rows do.
COVERAGE_KEYS = 4096
#: Stands for an entity that is null.
NO_ENTITY = -(1 << 63)


def coverage_changes(docs: DataFrame, window_days: int, lateness: str = "30 days") -> DataFrame:
    """(entity, change_day, companies, covered): what each arrival changes in the daily counts of rolling coverage.

    ``docs`` is a stream of (entity, day, version, flag). Of each entity the state holds the documents that a row in time
    can still touch: those since the watermark's day and the last before it. A row out of order changes what it has to and
    takes back what no longer holds, so the sums of all changes up to a day are that day's counts. Entities share keys of
    the state; a timer drops those whose last document's window is over.
    """

    def run(_, frames, state):
        held = {}
        for e, d, v, f in zip(*state.get, strict=True) if state.exists else ():
            held.setdefault(e, []).append((d, v, f))
        mark = max(0, state.getCurrentWatermarkMs())
        arrived = {}
        for frame in frames if not state.hasTimedOut else ():
            for e, d, v, f in zip(*(frame[c].tolist() for c in ("entity", "number", "version", "flag")), strict=True):
                arrived.setdefault(e, []).append((int(d), int(v), int(f)))
        out = []
        for e, rows in arrived.items():
            old = held.get(e, [])
            new = old + rows
            companies, covered = Counter(), Counter()
            for sign, some in ((-1, old), (1, new)):
                for start, end, flag in _intervals(some, window_days):
                    for day, step in ((start, sign), (end, -sign)):
                        companies[day] += step
                        covered[day] += step * flag
            latest = sorted({d: (d, v, f) for d, v, f in sorted(new)}.values())
            settled = [x for x in latest if x[0] < mark // DAY_MS]
            held[e] = settled[-1:] + latest[len(settled) :]
            out += [(e, d, companies[d], covered[d]) for d in sorted(companies) if companies[d] or covered[d]]
        ends = {e: (max(rows)[0] + window_days) * DAY_MS for e, rows in held.items()}
        kept = {e: rows for e, rows in held.items() if e in arrived or ends[e] > mark}
        if kept:
            state.update(tuple(list(x) for x in zip(*[(e, *r) for e, rows in kept.items() for r in rows], strict=True)))
            state.setTimeoutTimestamp(max(min(ends[e] for e in kept), mark + 1))
        elif state.exists:
            state.remove()
        yield pd.DataFrame(out, columns=["entity", "number", "companies", "covered"])

    rows = docs.filter("day is not null").withColumn("at", F.col("day").cast("timestamp")).withWatermark("at", lateness)
    rows = rows.select(F.coalesce(F.col("entity").cast("long"), F.lit(NO_ENTITY)).alias("entity"), "at", F.unix_date("day").alias("number"), "version", "flag")
    changes = rows.withColumn("key", F.pmod(F.xxhash64("entity"), F.lit(COVERAGE_KEYS))).groupBy("key").applyInPandasWithState(run, "entity long, number int, companies long, covered long", "entities array<long>, days array<int>, versions array<long>, flags array<int>", "append", "EventTimeTimeout")
    return changes.select(F.nullif("entity", F.lit(NO_ENTITY)).alias("entity"), F.date_from_unix_date("number").alias("change_day"), "companies", "covered")


def append_new(events: DataFrame, path: str, keys: list[str], checkpoint: str):
    """Each batch's rows whose key the history lacks are appended; a batch that is run again adds nothing."""

    def put(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        new = batch.dropDuplicates(keys)
        if exists(spark, path):
            new = delta(new, spark.read.schema(batch.schema).parquet(path), {k: k for k in keys})
        new.write.mode("append").parquet(path)

    return events.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)
