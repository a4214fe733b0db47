"""Rolling coverage and relevance: orders as documents of customers, flags and scores from their price."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import timeseries as S
from ..sources.io import table
from .base import register

LO, HI, DAYS = "1996-01-01", "1996-12-31", 120


def docs(spark, d):
    o = table(spark, d, "orders")
    return o.select(
        F.col("o_custkey").alias("entity"), F.col("o_orderdate").cast("date").alias("day"), F.col("o_orderkey").alias("version"),
        (F.col("o_totalprice") > 150000).cast("int").alias("flag_md"), (F.col("o_orderkey") % 2).cast("int").alias("flag_qa"),
        F.when(F.col("o_orderkey") % 3 != 0, (F.col("o_orderkey") % 16) / 16.0).alias("rel_md"), F.when(F.col("o_orderkey") % 5 != 0, (F.col("o_orderkey") % 8) / 8.0).alias("rel_qa"),
    )


SQL_LATEST = f"""docs AS (SELECT o_custkey AS entity, CAST(o_orderdate AS DATE) AS day, o_orderkey AS version, CAST(o_totalprice > 150000 AS INTEGER) AS flag_md, CAST(o_orderkey % 2 AS INTEGER) AS flag_qa,
 CASE WHEN o_orderkey % 3 <> 0 THEN (o_orderkey % 16) / 16.0 END AS rel_md, CASE WHEN o_orderkey % 5 <> 0 THEN (o_orderkey % 8) / 8.0 END AS rel_qa FROM orders),
 spine AS (SELECT CAST(unnest(generate_series(DATE '{LO}', DATE '{HI}', INTERVAL 1 DAY)) AS DATE) AS series_day),
 latest AS (SELECT s.series_day, d.* FROM spine s JOIN docs d ON d.day BETWEEN s.series_day - {DAYS - 1} AND s.series_day
 QUALIFY row_number() OVER (PARTITION BY s.series_day, entity ORDER BY day DESC, version DESC) = 1)"""


def latest(spark, d):
    return S.valid_days(docs(spark, d), "entity", "day", "version", DAYS, F.lit(LO).cast("date"), F.lit(HI).cast("date"))


@register(f"""WITH {SQL_LATEST} SELECT series_day, count(entity) AS company_count, CAST(sum(flag_md) AS BIGINT) AS covered, sum(flag_md) / nullif(count(entity), 0) AS coverage
 FROM spine LEFT JOIN latest USING (series_day) GROUP BY series_day""")
def rolling_coverage_120d(spark, d):
    """J7, A5, W2, R4, D6."""
    out = S.on_spine(S.rolling(latest(spark, d), "flag_md", "rel_md"), spark, LO, HI)
    return out.select("series_day", "company_count", "covered", "coverage")


@register(f"WITH {SQL_LATEST} SELECT series_day, count(*) AS company_count, avg(rel_md) AS relevance FROM latest GROUP BY series_day")
def rolling_relevance_120d(spark, d):
    """A4, P8. Scores are sixteenths, so sums are exact."""
    return S.rolling(latest(spark, d), "flag_md", "rel_md").select("series_day", "company_count", "relevance")


@register(f"""WITH {SQL_LATEST} SELECT series_day, c_mktsegment AS category, count(*) AS company_count, CAST(sum(flag_md) AS BIGINT) AS covered, avg(rel_md) AS relevance
 FROM latest JOIN customer ON entity = c_custkey GROUP BY ALL""")
def rolling_by_segment(spark, d):
    """Coverage and relevance of each segment in one aggregate."""
    j = latest(spark, d).join(table(spark, d, "customer"), F.col("entity") == F.col("c_custkey")).withColumnRenamed("c_mktsegment", "category")
    return S.rolling(j, "flag_md", "rel_md", "category").select("series_day", "category", "company_count", "covered", "relevance")


@register(f"""WITH {SQL_LATEST} SELECT version, (coalesce(rel_md, 0) + coalesce(rel_qa, 0)) / nullif((rel_md IS NOT NULL)::INT + (rel_qa IS NOT NULL)::INT, 0) AS rel_average,
 greatest(flag_md, flag_qa) AS cover_average FROM docs""")
def md_qa_average(spark, d):
    """A mean that skips nulls for relevance, an OR for coverage."""
    return docs(spark, d).select("version", S.mean_of_sections(F.col("rel_md"), F.col("rel_qa")).alias("rel_average"), S.either_covered(F.col("flag_md"), F.col("flag_qa")).alias("cover_average"))
