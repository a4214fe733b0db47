"""Rolling series: in a window of days up to each day, the latest document of each entity counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def valid_days(docs: DataFrame, entity: str, day: str, tie: str, window_days: int, lo: Column, hi: Column) -> DataFrame:
    """A row for each document and day on which it is its entity's latest within the window.

    A document is valid from its day until its window ends or the next one's day; so there is at most one row for each
    entity and day, and no ranking of exploded rows.
    """
    last = Window.partitionBy(entity, day).orderBy(F.col(tie).desc())
    docs = docs.withColumn("_r", F.row_number().over(last)).filter("_r = 1").drop("_r")
    following = F.lead(day).over(Window.partitionBy(entity).orderBy(day))
    until = F.least(F.date_add(day, window_days - 1), F.coalesce(F.date_sub(following, 1), F.date_add(day, window_days - 1)), hi)
    docs = docs.withColumn("_from", F.greatest(F.col(day), lo)).withColumn("_until", until)
    # sequence() counts downwards where the bounds cross.
    return docs.filter("_from <= _until").withColumn("series_day", F.explode(F.sequence("_from", "_until"))).drop("_from", "_until")


def rolling(valid: DataFrame, flag: str, score: str, *by: str) -> DataFrame:
    """Companies, those with the flag, their share and the mean score for each day."""
    return valid.groupBy("series_day", *by).agg(
        F.count(F.lit(1)).alias("company_count"), F.sum(flag).alias("covered"), F.try_divide(F.sum(flag), F.count(F.lit(1))).alias("coverage"), F.avg(score).alias("relevance")
    )


def on_spine(series: DataFrame, spark, lo: str, hi: str) -> DataFrame:
    """Every day of the range; days without a document have company_count 0 and null rates."""
    spine = spark.sql("select explode(sequence(cast(:lo as date), cast(:hi as date))) as series_day", args={"lo": lo, "hi": hi})
    return spine.join(series, "series_day", "left").fillna(0, ["company_count"])


def mean_of_sections(a: Column, b: Column) -> Column:
    """Mean of the values that are there."""
    n = a.isNotNull().cast("int") + b.isNotNull().cast("int")
    return F.try_divide(F.coalesce(a, F.lit(0.0)) + F.coalesce(b, F.lit(0.0)), n)


def either_covered(a: Column, b: Column) -> Column:
    return F.greatest(a, b)
