"""Keyed coverage state against brute force, and dictionary tables by both joins."""

from __future__ import annotations

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from loomtext.operators import dictionaries as D
from loomtext.streaming import jobs

EPOCH = date(2020, 1, 1)


def counts_by_day(docs, window, days):
    """Entities and flags of their latest document in the window, day by day."""
    out = []
    for k in range(days):
        day, latest = EPOCH + timedelta(k), {}
        for entity, at, version, flag in docs:
            if day - timedelta(window - 1) <= at <= day:
                latest[entity] = max(latest.get(entity, (date.min, 0, 0)), (at, version, flag))
        out.append((len(latest), sum(x[2] for x in latest.values())))
    return out


def test_coverage_changes_out_of_order_and_restarted(spark, tmp_path):
    """Rows out of order within the lateness take back what no longer holds; every batch starts from the checkpoint."""
    rng, docs = random.Random(5), []
    for batch in range(4):
        docs.append([(rng.randint(1, 6), EPOCH + timedelta(batch * 12 + rng.randint(-6, 12) if batch else rng.randint(0, 12)), rng.randint(1, 99) * 10 + batch, rng.randint(0, 1)) for _ in range(15)])
    schema = "entity long, day date, version long, flag int"
    for some in docs:
        spark.createDataFrame(some, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        stream = jobs.coverage_changes(jobs.stream_table(spark, f"{tmp_path}/in", "*.parquet", spark.createDataFrame([], schema).schema), 10, "40 days")
        jobs.appended(stream, f"{tmp_path}/out", f"{tmp_path}/state").awaitTermination()
    changes = spark.read.parquet(f"{tmp_path}/out").groupBy("change_day").agg(F.sum("companies"), F.sum("covered")).collect()
    got = [tuple(sum(r[c] for r in changes if r[0] <= EPOCH + timedelta(k)) for c in (1, 2)) for k in range(70)]
    assert got == counts_by_day([r for some in docs for r in some], 10, 70)


def test_coverage_state_is_dropped_after_its_window(spark, tmp_path):
    """After its window an entity starts anew, and the series has the gap."""
    schema = "entity long, day date, version long, flag int"
    days = [EPOCH, EPOCH + timedelta(100), EPOCH + timedelta(101)]
    for k, day in enumerate(days):
        spark.createDataFrame([(1 if k != 1 else 2, day, k, 1)], schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        stream = jobs.coverage_changes(jobs.stream_table(spark, f"{tmp_path}/in", "*.parquet", spark.createDataFrame([], schema).schema), 5, "1 day")
        jobs.appended(stream, f"{tmp_path}/out", f"{tmp_path}/state").awaitTermination()
    got = sorted((r.entity, (r.change_day - EPOCH).days, r.companies) for r in spark.read.parquet(f"{tmp_path}/out").collect())
    assert got == [(1, 0, 1), (1, 5, -1), (1, 101, 1), (1, 106, -1), (2, 100, 1), (2, 105, -1)]


def test_deduplication_within_a_watermark_takes_times_without_zone(spark, tmp_path):
    rows = "select 1 as id, timestamp_ntz'2024-01-01 00:00:00' as ts union all select 1, timestamp_ntz'2024-01-02 00:00:00' union all select 2, timestamp_ntz'2024-01-02 00:00:00'"
    source = spark.sql(rows)
    source.write.parquet(f"{tmp_path}/in")
    stream = jobs.deduplicated(jobs.stream_table(spark, f"{tmp_path}/in", "*.parquet", source.schema), "id", "ts")
    jobs.appended(stream, f"{tmp_path}/out", f"{tmp_path}/state").awaitTermination()
    assert sorted(r.id for r in spark.read.parquet(f"{tmp_path}/out").collect()) == [1, 2]


@pytest.mark.parametrize("bound", [0, 262_144])
def test_both_joins_give_the_same(spark, monkeypatch, bound):
    monkeypatch.setattr(D, "MAX_BROADCAST", bound)
    table = spark.createDataFrame([("a b", "X"), ("a b", "X"), ("a", "X"), ("a", "Y"), ("a b c", "Y"), (" ", "Y"), (None, "Y")], "term string, value string")
    rows = spark.createDataFrame([(1, ["a", "b", "c", "a", "b", "c"]), (2, []), (3, None), (4, ["z"])], "id long, words array<string>")
    lookup = D.Lookup(table)
    assert lookup.small == (bound > 0)
    found = {tuple(r) for r in D.topic_totals(rows, "words", lookup, "id").collect()}
    assert found == {(1, "X", 4, 2), (1, "Y", 3, 2)}
    words = spark.createDataFrame([("a",), ("q",), (None,)], "word string")
    assert {tuple(r) for r in D.base_forms(words, "word", lookup).collect()} == {("a", "X"), ("q", "q"), (None, None)}


def test_empty_table_matches_nothing(spark):
    lookup = D.Lookup(spark.createDataFrame([], "term string, value string"))
    rows = spark.createDataFrame([(1, ["a"])], "id long, words array<string>")
    assert D.hits(rows, "words", lookup, "id").collect() == []
