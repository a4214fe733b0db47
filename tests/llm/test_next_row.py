"""The next row in id order, where the order is cut into many ranges."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from loomtext.llm import fingerprints


@pytest.mark.parametrize("per_range", [1, 3, 50, 4096])
def test_next_row_over_ranges(spark, monkeypatch, per_range):
    monkeypatch.setattr(fingerprints, "RANGE_ROWS", per_range)
    ids = random.Random(3).sample(range(-500, 5000), 200)
    rows = [(i, f"text {i}") for i in ids]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    got = {r.doc_id: (r.x, r.next_x) for r in fingerprints.with_next(df, "doc_id", {"x": F.col("text")}).collect()}
    order = sorted(ids)
    assert got == {i: (f"text {i}", f"text {j}") for i, j in zip(order, order[1:] + order[:1], strict=True)}


@pytest.mark.parametrize("per_range", [1, 4])
def test_next_row_of_repeated_and_null_ids(spark, monkeypatch, per_range):
    monkeypatch.setattr(fingerprints, "RANGE_ROWS", per_range)
    rows = [(i, f"{i} {k}") for i in (None, -(2**63), 5, 5, 7, 9) for k in range(4)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = [(r.x, r.next_x) for r in fingerprints.with_next(df, "doc_id", {"x": F.col("text")}).collect()]
    texts = sorted(t for _, t in rows)
    assert sorted(x for x, _ in got) == texts and sorted(x for _, x in got) == texts


def test_next_row_of_one_row_and_none(spark):
    one = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    assert [tuple(r) for r in fingerprints.with_next(one, "doc_id", {"x": F.col("text")}).collect()] == [(1, "a", "a")]
    assert fingerprints.with_next(one.filter("doc_id > 1"), "doc_id", {"x": F.col("text")}).collect() == []
