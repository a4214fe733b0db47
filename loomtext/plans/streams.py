"""Queries that run streams over the given tables, in batches, and read what they wrote."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import timeseries as S
from ..sources.io import scratch, table
from ..streaming import jobs
from . import evaluation, series  # noqa: F401  (twins of evaluation are taken from ORACLES)
from .base import ORACLES, register


def in_batches(df, folder: str, parts, start):
    """Each part of ``df`` is added to the folder and ``start`` run to its end, from the state that the run before left."""
    for part in parts:
        df.filter(part).write.mode("append").parquet(f"{folder}/in")
        start().awaitTermination()


EVEN_ODD = ("event_id % 2 = 0", "event_id % 2 = 1")


@register(ORACLES["window_tumbling"])
def stream_tumbling(spark, d):
    """The streaming form of the daily window; the whole report after the last batch."""
    folder, events = scratch(spark, "tumbling"), table(spark, d, "events")
    cents = events.withColumn("value", F.round(F.col("value") * 100).cast("long"))
    stream = lambda: jobs.windowed(jobs.stream_table(spark, f"{folder}/in", "*.parquet", cents.schema), "ts", "1 day", None, "event_type")
    in_batches(cents, folder, EVEN_ODD, lambda: jobs.report(stream(), f"{folder}/out", f"{folder}/state"))
    out = jobs.last_report(spark, f"{folder}/out")
    return out.select(F.col("window.start").cast("timestamp_ntz").alias("start"), "event_type", "n", F.col("total").alias("cents"))


@register(ORACLES["window_session"])
def stream_sessions(spark, d):
    """Extension: sessions by a gap of a day, as a stream."""
    folder, events = scratch(spark, "sessions"), table(spark, d, "events")
    stream = lambda: jobs.sessions(jobs.stream_table(spark, f"{folder}/in", "*.parquet", events.schema), "ts", "1 day", "user_id", lateness="3650 days")
    in_batches(events, folder, EVEN_ODD, lambda: jobs.report(stream(), f"{folder}/out", f"{folder}/state"))
    return jobs.last_report(spark, f"{folder}/out").select("user_id", F.col("session_window.start").cast("timestamp_ntz").alias("start"), "n")


@register("""SELECT event_id, user_id, event_type, ts, event_id % 2 = 1 AND ts < (SELECT max(ts) FROM events WHERE event_id % 2 = 0) - INTERVAL 10 DAY AS late FROM events""")
def stream_late_rows(spark, d):
    """R2: two batches with late and repeated rows; keys once, late rows in a side table."""
    folder, events = scratch(spark, "late"), table(spark, d, "events").select("event_id", "user_id", "event_type", "ts")
    twice = events.unionAll(events)
    stream = lambda: jobs.stream_table(spark, f"{folder}/in", "*.parquet", events.schema)
    in_batches(twice, folder, EVEN_ODD, lambda: jobs.split_late(stream(), f"{folder}/out", ["event_id"], "ts", f"{folder}/state", "10 days"))
    main = spark.read.parquet(f"{folder}/out/main").withColumn("late", F.lit(False))
    side = spark.read.parquet(f"{folder}/out/late").dropDuplicates(["event_id"]).withColumn("late", F.lit(True))
    return main.unionByName(side).select("event_id", "user_id", "event_type", "ts", "late")


@register(ORACLES["rolling_coverage_120d"])
def stream_rolling_coverage(spark, d):
    """Rolling coverage from keyed state with timers; all changes summed up to a day are its counts."""
    folder = scratch(spark, "coverage")
    docs = series.docs(spark, d).select("entity", "day", "version", F.col("flag_md").alias("flag"))
    stream = lambda: jobs.coverage_changes(jobs.stream_table(spark, f"{folder}/in", "*.parquet", docs.schema), series.DAYS)
    parts = ("day < '1995-06-01'", "day >= '1995-06-01' and day < '1996-05-01'", "day >= '1996-05-01' or day is null")
    in_batches(docs, folder, parts, lambda: jobs.appended(stream(), f"{folder}/out", f"{folder}/state"))
    changes = spark.read.parquet(f"{folder}/out").groupBy("change_day").agg(F.sum("companies").alias("c"), F.sum("covered").alias("f"))
    upto = Window.orderBy("change_day")  # one row a day
    daily = changes.select(F.col("change_day").alias("day"), F.sum("c").over(upto).alias("company_count"), F.sum("f").over(upto).alias("covered"), F.lead("change_day").over(upto).alias("following"))
    held = daily.withColumn("last", F.coalesce(F.date_sub("following", 1), F.greatest("day", F.lit(series.HI).cast("date"))))
    each = held.select(F.explode(F.sequence("day", "last")).alias("series_day"), "company_count", "covered").filter("company_count > 0")
    out = S.on_spine(each.withColumn("coverage", F.try_divide("covered", "company_count")), spark, series.LO, series.HI)
    return out.select("series_day", "company_count", "covered", "coverage")
