"""Queries over versions, deltas, joins and ranks: orders stand in for transcript versions, customers for entities."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import dates as D
from ..operators import relational as R
from ..sources.io import table
from .base import register

EVENTS = "SELECT event_id, ts, user_id, event_type, value FROM events"


@register("SELECT l_orderkey, l_partkey, l_extendedprice * (1 - l_discount) AS net FROM lineitem WHERE l_returnflag = 'R' AND l_discount > 0.05")
def scan_filter_project(spark, d):
    """Only three columns and the filter's are read."""
    return table(spark, d, "lineitem").filter("l_returnflag = 'R' and l_discount > 0.05").select("l_orderkey", "l_partkey", (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("net"))


@register("SELECT o_orderkey, o_custkey FROM orders WHERE o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderdate < TIMESTAMP '1998-01-01'")
def date_range_scan(spark, d):
    """Half-open range."""
    return table(spark, d, "orders").filter("o_orderdate >= timestamp_ntz'1997-01-01' and o_orderdate < timestamp_ntz'1998-01-01'").select("o_orderkey", "o_custkey")


@register("SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 100000 AND o_orderstatus = 'F'")
def business_predicates(spark, d):
    """P3."""
    return table(spark, d, "orders").filter("o_totalprice > 100000 and o_orderstatus = 'F'").select("o_orderkey", "o_totalprice")


@register("SELECT o_orderkey, o_custkey FROM orders WHERE o_orderdate = (SELECT max(o_orderdate) FROM orders)")
def latest_batch(spark, d):
    """A scalar subquery."""
    o = table(spark, d, "orders")
    top = o.agg(F.max("o_orderdate").alias("top"))
    return o.join(F.broadcast(top), F.col("o_orderdate") == F.col("top")).select("o_orderkey", "o_custkey")


@register("SELECT l_orderkey, l_linenumber FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_shipdate <= o_orderdate + INTERVAL 30 DAY")
def lateness_filter(spark, d):
    """P5, R2."""
    j = table(spark, d, "lineitem").join(table(spark, d, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    return R.in_time(j, "o_orderdate", "l_shipdate", 30).select("l_orderkey", "l_linenumber")


@register("SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority NOT IN ('1-URGENT', '5-LOW')")
def keyword_rows_removed(spark, d):
    """P6."""
    return R.without_keywords(table(spark, d, "orders"), "o_orderpriority", ["1-URGENT", "5-LOW"]).select("o_orderkey", "o_orderpriority")


@register("SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_discount > 0.09 OR l_tax > 0.07 OR l_quantity > 49")
def any_metric_filter(spark, d):
    """P9."""
    return table(spark, d, "lineitem").filter("l_discount > 0.09 or l_tax > 0.07 or l_quantity > 49").select("l_orderkey", "l_linenumber")


@register("""SELECT n_name, count(*) AS n, sum(o_totalprice) AS total FROM orders JOIN customer ON o_custkey = c_custkey
 JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY n_name""")
def four_way_join(spark, d):
    """J1. The sum is taken of cents, so that its order doesn't matter."""
    j = table(spark, d, "orders").join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey")).join(table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return j.groupBy("n_name").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("o_totalprice")).alias("total"))


@register("SELECT o_orderkey, o_custkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_quantity > 45 AND CAST(l_orderkey AS VARCHAR) = CAST(o_orderkey AS VARCHAR))")
def delta_anti_join(spark, d):
    """J2, J2b, R3."""
    return R.delta(table(spark, d, "orders"), table(spark, d, "lineitem").filter("l_quantity > 45"), {"o_orderkey": "l_orderkey"}).select("o_orderkey", "o_custkey")


@register("""WITH hist AS (SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '1996-07-01'), new AS (SELECT * FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01')
 SELECT o_orderkey, o_custkey, o_totalprice FROM hist UNION ALL SELECT o_orderkey, o_custkey, o_totalprice FROM new WHERE NOT EXISTS (SELECT 1 FROM hist h WHERE h.o_orderkey = new.o_orderkey)""")
def merge_insert_only(spark, d):
    """SET4: history and a later batch overlap by half a year."""
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    day = F.col("o_orderdate")
    history, new = o.filter(day < F.lit("1996-07-01")), o.filter(day >= F.lit("1996-01-01"))
    return R.merge_insert(history, new, ["o_orderkey"]).select("o_orderkey", "o_custkey", "o_totalprice")


MONTHLY = """SELECT strftime(o_orderdate, '%Y-%m') AS ym, o_custkey, sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS cap FROM orders GROUP BY ALL"""


def monthly_caps(spark, d):
    ym = F.date_format("o_orderdate", "yyyy-MM").alias("ym")
    return table(spark, d, "orders").groupBy(ym, "o_custkey").agg(F.sum(F.round(F.col("o_totalprice") * 100).cast("long")).alias("cap"))


@register(f"""WITH m AS ({MONTHLY}), top AS (SELECT ym, o_custkey FROM m QUALIFY row_number() OVER (PARTITION BY ym ORDER BY cap DESC, o_custkey) <= 5)
 SELECT o_orderkey, o_custkey FROM orders WHERE (strftime(o_orderdate, '%Y-%m'), o_custkey) IN (SELECT ym, o_custkey FROM top)""")
def monthly_topn_semi_join(spark, d):
    """One semi join for all months."""
    w = Window.partitionBy("ym").orderBy(F.col("cap").desc(), "o_custkey")
    top = monthly_caps(spark, d).withColumn("r", F.row_number().over(w)).filter("r <= 5")
    o = table(spark, d, "orders").withColumn("ym", F.date_format("o_orderdate", "yyyy-MM"))
    return R.members_of(o, top, ["ym", "o_custkey"]).select("o_orderkey", "o_custkey")


@register(f"""WITH m AS ({MONTHLY}), r AS (SELECT *, row_number() OVER (PARTITION BY ym ORDER BY cap DESC, o_custkey) AS rn, rank() OVER (PARTITION BY ym ORDER BY cap DESC) AS rk FROM m)
 SELECT ym, o_custkey, CASE WHEN rn <= 10 THEN 'mega' WHEN rn <= 50 THEN 'large' ELSE 'small' END AS bucket, CAST(rk <= 15 AS INTEGER) AS in_top FROM r""")
def rank_buckets_by_month(spark, d):
    """W1, W1b, P18."""
    w = Window.partitionBy("ym").orderBy(F.col("cap").desc(), "o_custkey")
    by_cap = Window.partitionBy("ym").orderBy(F.col("cap").desc())
    m = monthly_caps(spark, d).withColumn("rn", F.row_number().over(w)).withColumn("rk", F.rank().over(by_cap))
    return m.select("ym", "o_custkey", R.rank_bucket(F.col("rn"), ("mega", 10), ("large", 50), rest="small").alias("bucket"), (F.col("rk") <= 15).cast("int").alias("in_top"))


@register("""SELECT a.l_orderkey, a.l_partkey, a.l_linenumber, a.q, b.p FROM (SELECT l_orderkey, l_partkey, l_linenumber, l_quantity AS q FROM lineitem WHERE l_discount > 0.05) a
 JOIN (SELECT l_orderkey, l_partkey, l_linenumber, l_extendedprice AS p FROM lineitem WHERE l_tax > 0.04) b USING (l_orderkey, l_partkey, l_linenumber)""")
def score_table_join(spark, d):
    """Three keys."""
    li, keys = table(spark, d, "lineitem"), ["l_orderkey", "l_partkey", "l_linenumber"]
    return li.filter("l_discount > 0.05").select(*keys, F.col("l_quantity").alias("q")).join(li.filter("l_tax > 0.04").select(*keys, F.col("l_extendedprice").alias("p")), keys)


@register("SELECT o_custkey, o_orderkey FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) = 1")
def first_version_per_key(spark, d):
    """W3, W4."""
    return R.earliest(table(spark, d, "orders"), ["o_custkey"], ["o_orderdate", "o_orderkey"]).select("o_custkey", "o_orderkey")


@register("SELECT o_custkey, o_orderkey, o_totalprice FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1")
def latest_version_per_key(spark, d):
    """A2, W2, W5."""
    return R.latest(table(spark, d, "orders"), ["o_custkey"], ["o_orderdate", "o_orderkey"]).select("o_custkey", "o_orderkey", "o_totalprice")


@register("SELECT o_custkey, o_orderkey FROM orders QUALIFY rank() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC) = 1")
def latest_with_ties(spark, d):
    """W3b."""
    return R.latest(table(spark, d, "orders"), ["o_custkey"], ["o_orderdate"], ties="all").select("o_custkey", "o_orderkey")


@register("""SELECT o_custkey, o_totalprice FROM (SELECT * FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC NULLS LAST, o_orderkey) = 1)
 ORDER BY o_totalprice DESC NULLS LAST, o_orderkey LIMIT 102""")
def topk_distinct_entities(spark, d):
    """The top-k report."""
    return R.top_distinct(table(spark, d, "orders"), "o_custkey", "o_totalprice", 102, "o_orderkey").select("o_custkey", "o_totalprice")


@register("""SELECT conv_id, string_agg(text, ' ' ORDER BY turn, role, text) AS joined, count(*) AS n_turns, min_by(role, (turn, role, text)) AS first_role FROM conversations GROUP BY conv_id""")
def regroup_split_calls(spark, d):
    """A1: the pieces of one call in their order."""
    g = table(spark, d, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("t"))
    return g.select("conv_id", F.array_join(F.transform("t", lambda x: x["text"]), " ").alias("joined"), F.size("t").cast("long").alias("n_turns"), F.get("t", F.lit(0))["role"].alias("first_role"))


SEGMENT = """SELECT 'All' AS category, strftime(o_orderdate, '%Y-%m') AS ym, o_custkey FROM orders UNION ALL
 SELECT c_mktsegment, strftime(o_orderdate, '%Y-%m'), o_custkey FROM orders JOIN customer ON o_custkey = c_custkey UNION ALL
 SELECT CASE WHEN o_totalprice > 200000 THEN 'mega' WHEN o_totalprice > 100000 THEN 'large' ELSE 'small' END, strftime(o_orderdate, '%Y-%m'), o_custkey FROM orders"""


@register(f"SELECT category, ym, count(*) AS n, count(DISTINCT o_custkey) AS entities FROM ({SEGMENT}) GROUP BY category, ym")
def segment_union_all(spark, d):
    """One pass; every row has its categories in an array."""
    o = table(spark, d, "orders").join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    size = F.when(F.col("o_totalprice") > 200000, "mega").when(F.col("o_totalprice") > 100000, "large").otherwise("small")
    rows = o.select(F.explode(F.array(F.lit("All"), "c_mktsegment", size)).alias("category"), F.date_format("o_orderdate", "yyyy-MM").alias("ym"), "o_custkey")
    return rows.groupBy("category", "ym").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("o_custkey").alias("entities"))


@register("SELECT min(o_orderdate) AS lowest, max(o_orderdate) AS highest, count(*) AS n FROM orders")
def profile_table(spark, d):
    """P22, A3."""
    return R.profile(table(spark, d, "orders"), "o_orderdate")


@register("SELECT count(l_quantity) AS n, avg(l_quantity) AS mean, min(l_quantity) AS lowest, max(l_quantity) AS highest FROM lineitem")
def describe_column(spark, d):
    """A19."""
    return table(spark, d, "lineitem").agg(F.count("l_quantity").alias("n"), F.avg("l_quantity").alias("mean"), F.min("l_quantity").alias("lowest"), F.max("l_quantity").alias("highest"))


@register("SELECT DISTINCT strftime(o_orderdate, '%Y-%m') AS ym, o_orderstatus FROM orders")
def distinct_months(spark, d):
    """A23, SET3."""
    return table(spark, d, "orders").select(F.date_format("o_orderdate", "yyyy-MM").alias("ym"), "o_orderstatus").dropDuplicates()


@register("""WITH h AS (SELECT o_custkey, o_orderkey, o_totalprice, lag(o_totalprice) OVER w AS prev, rank() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC) AS place,
 row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS r FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey))
 SELECT o_custkey, place, o_totalprice - prev AS delta, CASE WHEN o_totalprice > prev THEN 'up' WHEN o_totalprice < prev THEN 'down' ELSE 'same' END AS direction FROM h WHERE r = 1""")
def latest_position_and_delta(spark, d):
    """W6."""
    by_time = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    newest = Window.partitionBy("o_custkey").orderBy(F.col("o_orderdate").desc(), F.col("o_orderkey").desc())
    place = Window.partitionBy("o_custkey").orderBy(F.col("o_totalprice").desc())
    h = table(spark, d, "orders").withColumns({"prev": F.lag("o_totalprice").over(by_time), "place": F.rank().over(place).cast("long"), "r": F.row_number().over(newest)}).filter("r = 1")
    return h.select("o_custkey", "place", (F.col("o_totalprice") - F.col("prev")).alias("delta"), F.when(F.col("o_totalprice") > F.col("prev"), "up").when(F.col("o_totalprice") < F.col("prev"), "down").otherwise("same").alias("direction"))


@register("SELECT p_brand, p_partkey, p_retailprice FROM part QUALIFY row_number() OVER (PARTITION BY p_brand ORDER BY p_retailprice DESC, p_partkey) = 1")
def best_run_per_group(spark, d):
    """W7, T5."""
    return R.one_per_key(table(spark, d, "part"), ["p_brand"], [F.col("p_retailprice").desc(), F.col("p_partkey")]).select("p_brand", "p_partkey", "p_retailprice")


@register("""SELECT o_orderstatus, count(*) FILTER (o_orderpriority = '1-URGENT') AS urgent_count, count(*) FILTER (o_orderpriority = '2-HIGH') AS high_count, count(*) FILTER (o_orderpriority = '5-LOW') AS low_count FROM orders GROUP BY o_orderstatus""")
def wide_pivot(spark, d):
    """Wide layout from long counts, names given."""
    names = {"1-URGENT": "urgent_count", "2-HIGH": "high_count", "5-LOW": "low_count"}
    long = table(spark, d, "orders").groupBy("o_orderstatus", "o_orderpriority").agg(F.count(F.lit(1)).alias("n"))
    out = R.wide(long, ["o_orderstatus"], F.col("o_orderpriority"), "n", list(names))
    return out.select("o_orderstatus", *[F.coalesce(F.col(f"`{k}`"), F.lit(0)).alias(v) for k, v in names.items()])


@register("SELECT event_id, CAST(json_extract_string(props, '$.k') AS VARCHAR) AS k, strftime(ts, '%Y-%m') AS ym FROM events WHERE value IS NOT NULL")
def parsed_props(spark, d):
    """N1, N11, D3."""
    return table(spark, d, "events").filter("value is not null").select("event_id", F.get_json_object("props", "$.k").alias("k"), F.date_format("ts", "yyyy-MM").alias("ym"))


@register("""SELECT date_trunc('month', ts) AS month, event_type, count(*) AS n, CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS cents FROM events GROUP BY ALL""")
def tumbling_months(spark, d):
    """R6."""
    return table(spark, d, "events").groupBy(F.date_trunc("month", "ts").cast("timestamp_ntz").alias("month"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum(F.round(F.col("value") * 100).cast("long")).alias("cents"))


@register("""SELECT event_id, user_id FROM events WHERE ts > (SELECT max(ts) FROM events WHERE date_trunc('month', ts) < (SELECT date_trunc('month', max(ts)) FROM events))""")
def high_watermark_pull(spark, d):
    """What came after all earlier months, of which the watermark is taken."""
    e = table(spark, d, "events")
    last = e.agg(F.date_trunc("month", F.max("ts")).alias("last"))
    seen = e.join(F.broadcast(last), F.date_trunc("month", "ts") < F.col("last")).agg(F.max("ts").alias("seen"))
    return e.join(F.broadcast(seen), F.col("ts") > F.col("seen")).select("event_id", "user_id")


_QUARTERS = ", ".join(f"'q' || quarter(o_orderdate - INTERVAL {3 * k} MONTH) || right(CAST(year(o_orderdate - INTERVAL {3 * k} MONTH) AS VARCHAR), 2)" for k in (1, 2, 3, 4))


@register(f"""SELECT o_orderkey, CAST(o_orderdate AS DATE) - CASE WHEN dayofweek(o_orderdate) = 1 THEN 3 ELSE 1 END AS stamp, strftime(o_orderdate, '%Y-%m') AS ym, strftime(o_orderdate, '%Y%m%d') AS packed,
 CAST(date_trunc('month', o_orderdate - INTERVAL 15 MONTH) AS DATE) AS range_start, CAST(date_trunc('month', o_orderdate - INTERVAL 12 MONTH) AS DATE) AS legacy_start, CAST(date_trunc('month', o_orderdate) AS DATE) AS range_end,
 CAST(o_orderdate AS DATE) - 120 AS lookback, concat_ws(',', {_QUARTERS}) AS quarters FROM orders""")
def calendar_stamps(spark, d):
    """Business day before, month, ranges by month, look-back, last four quarters."""
    day = F.col("o_orderdate").cast("date")
    start, end = D.month_range_of(day, years_back=1, months_back=3)
    legacy, _ = D.month_range_of(day, years_back=1, months_back=3, legacy=True)
    return table(spark, d, "orders").select(
        "o_orderkey", D.business_day_before(day).alias("stamp"), D.year_month(F.col("o_orderdate")).alias("ym"), D.stamp(F.col("o_orderdate"), "yyyyMMdd").alias("packed"),
        start.alias("range_start"), legacy.alias("legacy_start"), end.alias("range_end"), F.date_sub(day, 120).alias("lookback"), F.array_join(D.quarters_before(day, 4), ",").alias("quarters"),
    )


@register("SELECT event_id, timezone('America/New_York', timezone('UTC', ts)) AS eastern FROM events")
def utc_to_eastern(spark, d):
    """D4."""
    return table(spark, d, "events").select("event_id", D.eastern_ntz(F.col("ts")).alias("eastern"))
