"""Dates, call turns and phrase vectors."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from loomtext.functions import calls, dates
from loomtext.operators import relational as R
from loomtext.operators import vectors as V


def test_dates(spark):
    t = date(2023, 10, 17)
    assert [dates.month_range(t, y)[0] for y in (1, 5, 0)] == [date(2022, 10, 1), date(2018, 10, 1), date(2023, 10, 1)]
    assert dates.month_range(t, 0, 10) == (date(2022, 12, 1), date(2023, 10, 1))
    assert dates.last_four_quarters(date(2024, 2, 1)) == ["q423", "q323", "q223", "q123"]
    d = lambda x: dates.business_day_before(F.lit(x))
    assert tuple(spark.range(1).select(d(date(2024, 1, 8)), d(date(2024, 1, 9))).first()) == (date(2024, 1, 5), date(2024, 1, 8))


def test_turns(spark):
    text = "Jane Doe: Why so\nlow?\nJohn Roe: Costs.\nAnn Poe: And demand.\nJane Doe: Thanks. What next?\nJohn Roe: Growth.\n"
    r = spark.createDataFrame([(text,)], "t string").select(calls.turns(F.col("t")).alias("turns"), calls.participants(F.col("t")).alias("who")).withColumn("qa", calls.questions_and_answers(F.col("turns"), F.array(F.lit("Jane Doe")))).first()
    assert r.who == ["Jane Doe", "John Roe", "Ann Poe"] and r.turns[0].said == "Why so low?"
    assert [tuple(x) for x in r.qa] == [("Why so low?", "Costs. And demand."), ("Thanks. What next?", "Growth.")]


def test_bigrams_and_phrases(spark):
    w = F.array(*[F.lit(x) for x in ["new", "york", "city", "new", "york"]])
    got = spark.range(1).select(calls.joined_bigrams(w, F.array(F.lit("new_york"), F.lit("york_city")))).first()[0]
    assert got == ["new_york", "city", "new_york"]
    table = spark.createDataFrame([("strong", [1.0, 0.0]), ("demand", [0.0, 1.0]), ("weak_demand", [5.0, 5.0])], "word string, vector array<double>")
    out = {r.phrase: r.vector for r in V.embedded_phrases(spark.createDataFrame([("strong demand",), ("weak demand",), ("none",)], "phrase string"), table).collect()}
    assert out == {"strong demand": [0.5, 0.5], "weak demand": [5.0, 5.0], "none": None}


def test_map_columns(spark):
    df = spark.createDataFrame([({"a": 1},)], "m map<string,int>")
    assert R.map_columns(df, "m", ["a", "b"]).collect() == [(1, None)]
    assert R.same_columns(df, df)
