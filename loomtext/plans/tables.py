"""Queries over sources, sinks, table maintenance and columns: written, read back and compared with the table."""

from __future__ import annotations

from datetime import date
from uuid import uuid4

from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import relational as R
from ..sources import io
from ..sources.io import scratch, table
from .base import register


@register("SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders")
def csv_round_trip(spark, d):
    """A CSV sink and its scan by schema."""
    path = f"{scratch(spark, 'csv')}/orders.csv"
    io.write_table(table(spark, d, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice"), path, "overwrite")
    return io.read_csv(spark, path, "o_orderkey long, o_orderpriority string, o_totalprice double")


@register("SELECT p_partkey, p_name, p_retailprice FROM part UNION ALL SELECT p_partkey, p_name, p_retailprice FROM part")
def parquet_append(spark, d):
    """Gzip Parquet, appended to."""
    path, rows = f"{scratch(spark, 'parquet')}/part.parquet", table(spark, d, "part").select("p_partkey", "p_name", "p_retailprice")
    for _ in range(2):
        io.write_table(rows, path)
    return spark.read.parquet(path)


@register("SELECT s_suppkey, s_name FROM supplier")
def truncate_and_load(spark, d):
    """S3, S3b, SET5: the second load replaces the first."""
    path, rows = f"{scratch(spark, 'load')}/supplier", table(spark, d, "supplier").select("s_suppkey", "s_name")
    io.truncate_and_load(rows.unionByName(rows), path)
    io.truncate_and_load(rows, path)
    return spark.read.schema(rows.schema).parquet(path)


@register("""SELECT o_orderkey, o_custkey, CASE WHEN o_orderdate >= TIMESTAMP '1996-01-01' THEN 'new' ELSE 'old' END AS batch FROM orders""")
def merge_table(spark, d):
    """S3: a later batch, which overlaps the table by half a year, is merged into it."""
    path, o = f"{scratch(spark, 'merge')}/orders", table(spark, d, "orders")
    rows = lambda keep, name: o.filter(keep).select("o_orderkey", "o_custkey", F.lit(name).alias("batch"))
    rows(F.col("o_orderdate") < F.lit("1996-07-01"), "old").write.parquet(path)
    io.merge_into(spark, path, rows(F.col("o_orderdate") >= F.lit("1996-01-01"), "new"), ["o_orderkey"])
    return spark.read.schema("o_orderkey long, o_custkey long, batch string").parquet(path)


@register("SELECT DISTINCT word, 'words' AS kind FROM (SELECT unnest(string_split(lower(p_name), ' ')) AS word FROM part) UNION ALL SELECT DISTINCT word, 'lines' FROM (SELECT unnest(string_split(lower(p_name), ' ')) AS word FROM part) UNION ALL SELECT '', 'lines'")
def lexicon_files(spark, d):
    """Word lists, blank lines left out or kept."""
    path = scratch(spark, "lexicon")
    words = table(spark, d, "part").select(F.explode(F.split("p_name", " ")).alias("w"))
    lines = words.select(F.concat(F.lit("  "), F.upper("w"), F.lit(" ")).alias("value"))
    lines.unionByName(spark.range(1).select(F.lit("  ").alias("value"))).write.mode("overwrite").text(path)
    return io.read_lexicon(spark, path).withColumn("kind", F.lit("words")).unionByName(io.read_lexicon(spark, path, keep_blank=True).withColumn("kind", F.lit("lines")))


@register("SELECT lower(p_brand) AS word, CAST(count(*) AS INTEGER) AS n FROM part GROUP BY p_brand")
def word_count_files(spark, d):
    """S8c, S8d: lines of a word and its count; a malformed line is left out, the strict reader passes a file without one."""
    path, fine = scratch(spark, "counts"), scratch(spark, "counts")
    lines = table(spark, d, "part").groupBy("p_brand").agg(F.count(F.lit(1)).alias("n")).select(F.concat(F.replace("p_brand", F.lit(" "), F.lit("_")), F.lit(" "), F.col("n").cast("string")).alias("value"))
    lines.write.mode("overwrite").text(fine)
    lines.unionByName(spark.range(1).select(F.lit("no count here").alias("value"))).write.mode("overwrite").text(path)
    return io.read_counts(spark, path).intersectAll(io.read_counts(spark, fine, strict=True))


@register("SELECT lower(n_name) || chr(39) || 's' AS short, lower(n_name) || ' is' AS long FROM nation")
def contraction_file(spark, d):
    """S8e: a file that holds one dictionary literal."""
    path = scratch(spark, "contractions")
    pairs = F.concat_ws(", ", F.collect_list(F.concat(F.lit('"'), F.lower("n_name"), F.lit("'s"), F.lit('": "'), F.lower("n_name"), F.lit(' is"'))))
    table(spark, d, "nation").agg(F.concat(F.lit("{"), pairs, F.lit("}")).alias("value")).coalesce(1).write.mode("overwrite").text(path)
    return io.read_contractions(spark, path)


@register("SELECT CAST(n_regionkey AS VARCHAR) AS region, CAST(sum(length(n_name) + 1) AS BIGINT) AS bytes FROM nation GROUP BY n_regionkey")
def listed_files(spark, d):
    """Files below a folder, with their lengths."""
    path = scratch(spark, "files")
    table(spark, d, "nation").select("n_name", F.col("n_regionkey").cast("string").alias("region")).write.mode("overwrite").partitionBy("region").text(path)
    files = io.read_files(spark, path, "*.txt").select(F.regexp_extract("path", "region=([0-9]+)", 1).alias("region"), "length")
    return files.groupBy("region").agg(F.sum("length").alias("bytes"))


@register("SELECT DATE '2024-03-08' AS archive_dt, count(*) AS n FROM nation UNION ALL SELECT DATE '2024-03-12', count(*) FROM nation")
def archived_days(spark, d):
    """A Monday's rows go under its Friday; what is over thirty days old is deleted, the rest read by a partition filter."""
    path, rows = scratch(spark, "archive"), table(spark, d, "nation").select("n_nationkey")
    for day in (date(2024, 1, 3), date(2024, 3, 11), date(2024, 3, 13)):
        io.archive(rows, path, day)
    if io.drop_expired(spark, path, date(2024, 3, 13)) != ["archive_dt=2024-01-02"]:
        raise RuntimeError("the expired day was not dropped")
    kept = io.within_retention(spark.read.parquet(path), date(2024, 3, 13))
    return kept.groupBy("archive_dt").agg(F.count(F.lit(1)).alias("n"))


@register("SELECT event_type, count(*) AS n FROM events WHERE value > 10 GROUP BY event_type")
def templated_query(spark, d):
    """A whole statement, names filled in and values bound."""
    name = f"events_{uuid4().hex}"
    table(spark, d, "events").createOrReplaceTempView(name)
    return io.query(spark, io.fill_template("select event_type, count(*) as n from {source} where value > :lowest group by event_type", source=name), lowest=10)


@register("SELECT CAST(0 AS BIGINT) AS doc_id, '' AS text, CAST(0 AS DOUBLE) AS score WHERE false")
def empty_frame(spark, d):
    """S15."""
    return io.empty(spark, "doc_id long, text string, score double")


@register("SELECT l_orderkey, count(*) AS n, min(o_custkey) AS o_custkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY l_orderkey")
def bucketed_join(spark, d):
    """Two tables in buckets of the join's key, so that neither is shuffled."""
    names = [f"bucketed_{uuid4().hex}" for _ in range(2)]
    io.write_bucketed(table(spark, d, "lineitem").select("l_orderkey", "l_linenumber"), names[0], 8, "l_orderkey", path=scratch(spark, "bucketed"))
    io.write_bucketed(table(spark, d, "orders").select("o_orderkey", "o_custkey"), names[1], 8, "o_orderkey", path=scratch(spark, "bucketed"))
    j = spark.table(names[0]).join(spark.table(names[1]).hint("merge"), F.col("l_orderkey") == F.col("o_orderkey"))
    return j.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"), F.min("o_custkey").alias("o_custkey"))


@register("""WITH g AS (SELECT conv_id, count(*) AS k, list('user ' || turn ORDER BY turn) FILTER (role = 'user') AS u, list('other ' || turn ORDER BY turn) FILTER (role <> 'user') AS o FROM conversations GROUP BY conv_id)
 SELECT conv_id, CASE WHEN k > 1 THEN 'call ' || conv_id END AS title, CASE WHEN k > 1 THEN coalesce(array_to_string(u, ','), '') ELSE '' END AS management, CASE WHEN k > 1 THEN coalesce(array_to_string(o, ','), '') ELSE '' END AS questions, CASE WHEN k > 1 THEN 'no' ELSE 'yes' END AS error FROM g""")
def transcript_sections(spark, d):
    """Documents of XML, made from the calls; those of one turn are cut off, and keep their row."""
    p = lambda who, name: F.array_join(F.transform(F.array_sort(F.collect_list(F.when(who, F.col("turn")))), lambda t: F.concat(F.lit(f"<p>{name} "), t.cast("string"), F.lit("</p>"))), "")
    user = F.col("role") == "user"
    g = table(spark, d, "conversations").groupBy("conv_id").agg(F.count(F.lit(1)).alias("k"), p(user, "user").alias("u"), p(~user, "other").alias("o"))
    section = lambda name, c: F.concat(F.lit(f'<section name="{name}"><speaker id="1"><plist>'), c, F.lit("</plist></speaker></section>"))
    whole = F.concat(F.lit('<transcript id="1"><meta><title>call '), F.col("conv_id").cast("string"), F.lit("</title></meta><body>"), section("MANAGEMENT DISCUSSION SECTION", F.col("u")), section("Q&amp;A", F.col("o")), F.lit("</body></transcript>"))
    xml = g.select("conv_id", F.when(F.col("k") > 1, whole).otherwise(F.lit("<transcript><meta>")).alias("raw_xml"))
    out = io.parse_transcripts(xml)
    return out.select("conv_id", "title", F.array_join("management", ",").alias("management"), F.array_join("questions", ",").alias("questions"), "error")


@register("SELECT c_custkey, lower(c_mktsegment) AS segment, c_name || '/' || lower(c_mktsegment) AS label, c_acctbal > 0 AS positive FROM customer")
def declared_steps(spark, d):
    """Columns by declared steps, of one input, of several, and of one made before; a step without its input is skipped."""
    steps = [("segment", "c_mktsegment", F.lower), ("label", ["c_name", "segment"], lambda a, b: F.concat(a, F.lit("/"), b)), ("lost", "not_there", F.lower), ("positive", "c_acctbal", lambda x: x > 0)]
    return R.transformed(table(spark, d, "customer"), steps, missing="skip").select("c_custkey", "segment", "label", "positive")


@register("SELECT o_orderkey AS id, o_totalprice AS A_COUNT_MD, o_totalprice * 2 AS A_COUNT_QA, o_totalprice * 3 AS A_REL_MD, o_totalprice * 4 AS A_REL_QA FROM orders")
def renamed_columns(spark, d):
    """Names made from parts, dots taken out, renamed by part, and chosen by part and pattern."""
    names = R.metric_names(["A"], ["COUNT", "REL"], ["MD", "QA"])
    df = table(spark, d, "orders").select(F.col("o_orderkey").alias("id"), *[(F.col("o_totalprice") * (k + 1)).alias(n.replace("COUNT", "NUM") + ".") for k, n in enumerate(names)])
    df = R.renamed_by_part(R.without_dots(df), {"NUM": "COUNT"})
    return df.select("id", *R.columns_like(df, "COUNT"), *R.matching_columns(df, "^A_REL_(MD|QA)$"))


@register("SELECT c_custkey, CAST(c_acctbal AS FLOAT) AS c_acctbal, TRY_CAST(c_name AS INTEGER) AS c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey FROM customer")
def cast_to_schema(spark, d):
    """A block of columns cast to their types; what can't be read is null."""
    rows = table(spark, d, "customer").select("c_custkey", F.col("c_acctbal").cast("string").alias("c_acctbal"), "c_name", "c_nationkey")
    return R.cast_block(rows, {"c_acctbal": "float", "c_name": "int", "c_nationkey": "string"})


@register("SELECT event_id, CASE WHEN value > 10 THEN value END AS value FROM events")
def nan_replaced(spark, d):
    """P15."""
    return R.nan_to_null(table(spark, d, "events").select("event_id", F.when(F.col("value") > 10, F.col("value")).otherwise(F.when(F.col("value").isNotNull(), F.lit(float("nan")))).alias("value")))


@register("SELECT event_type, sum(CAST(round(value * 100) AS BIGINT)) FILTER (value > 10)::BIGINT AS cents, CAST(NULL AS DOUBLE) AS nothing FROM events GROUP BY event_type")
def nan_aware_sum(spark, d):
    """What is no number is left out; null where nothing is."""
    e = table(spark, d, "events").select("event_type", F.when(F.col("value") > 10, F.round(F.col("value") * 100)).otherwise(float("nan")).alias("v"), F.lit(float("nan")).alias("n"))
    return e.groupBy("event_type").agg(R.nan_sum("v").cast("long").alias("cents"), R.nan_sum("n").alias("nothing"))


@register("SELECT o_orderkey, o_custkey AS customer, CAST(NULL AS BIGINT) AS nobody FROM orders")
def map_expanded(spark, d):
    """Keys of a map as columns, by a known list."""
    m = table(spark, d, "orders").select("o_orderkey", F.create_map(F.lit("customer"), F.col("o_custkey")).alias("m"))
    return R.map_columns(m, "m", ["customer", "nobody"])


@register("SELECT p_partkey, unnest(string_split(p_name, ' ')) AS word, CAST(len(string_split(p_name, ' ')) AS INTEGER) AS n FROM part")
def lists_exploded(spark, d):
    """Arrays written as JSON, read back, and laid out in rows; what is no list has none."""
    p = table(spark, d, "part").select("p_partkey", F.to_json(F.split("p_name", " ")).alias("words"))
    p = p.unionByName(p.select("p_partkey", F.lit("no list").alias("words"))).withColumn("words", X.parse_list(F.col("words")))
    return p.select("p_partkey", F.explode("words").alias("word"), F.size("words").alias("n"))


@register("""SELECT p_partkey, upper(replace(p_type, ' ', '_')) AS topic, CASE WHEN len(string_split(t, '_')) = 2 THEN replace(t, '_', ' ') ELSE t END AS term FROM (SELECT p_partkey, p_type, replace(p_type, ' ', '_') AS t FROM part)""")
def topic_names(spark, d):
    """P20, P21."""
    return table(spark, d, "part").select("p_partkey", X.topic_key(F.col("p_type")).alias("topic"), X.spaced_terms(F.replace("p_type", F.lit(" "), F.lit("_"))).alias("term"))


@register("SELECT s_suppkey, s_name FROM supplier")
def shuffled_rows(spark, d):
    """All rows, in an order by a seeded hash."""
    return R.shuffled(table(spark, d, "supplier").select("s_suppkey", "s_name"))


@register("""SELECT strftime(o_orderdate, '%Y-%m') AS ym, o_orderkey, CAST(NULL AS VARCHAR) AS note FROM orders UNION ALL SELECT CAST(NULL AS VARCHAR), CAST(NULL AS BIGINT), r_name FROM region""")
def union_of_frames(spark, d):
    """SET1, SET2: frames of unlike columns one after the other; months in one pass instead of a loop."""
    months = table(spark, d, "orders").select(F.date_format("o_orderdate", "yyyy-MM").alias("ym"), "o_orderkey")
    return R.concatenated(months, table(spark, d, "region").select(F.col("r_name").alias("note"))).select("ym", "o_orderkey", "note")


@register("SELECT n_nationkey, CASE WHEN n_regionkey < 3 THEN 'left' ELSE 'right' END AS side FROM nation WHERE n_regionkey <> 3")
def frame_differences(spark, d):
    """SET11, SET12: rows that one of two frames has more often; their columns are the same set."""
    n = table(spark, d, "nation")
    a, b = n.filter("n_regionkey <= 3").select("n_nationkey"), n.filter("n_regionkey >= 3").select("n_nationkey")
    if not R.same_columns(a, b):
        raise ValueError("the columns differ")
    return R.differences(a, b)


@register("SELECT o_orderkey, count(*) AS n FROM orders JOIN lineitem ON CAST(o_orderkey AS VARCHAR) = CAST(l_orderkey AS VARCHAR) GROUP BY o_orderkey")
def surrogate_join(spark, d):
    """A join on strings by their hashes."""
    o = table(spark, d, "orders").select("o_orderkey", F.col("o_orderkey").cast("string").alias("key"))
    rows = table(spark, d, "lineitem").select(F.col("l_orderkey").cast("string").alias("key"), "l_linenumber")
    return R.joined_by_surrogate(o, rows, "key").groupBy("o_orderkey").agg(F.count(F.lit(1)).alias("n"))


@register("SELECT n_regionkey, n_name, n_nationkey FROM nation ORDER BY n_regionkey, n_name")
def sorted_report(spark, d):
    """T3, T4."""
    return table(spark, d, "nation").select("n_regionkey", "n_name", "n_nationkey").orderBy("n_regionkey", "n_name")


@register("""SELECT event_id, ts AS at_ts, CAST(NULL AS TIMESTAMP) AS other_ts FROM (SELECT event_id, CAST(strftime(ts, '%Y-%m-%d %H:%M:%S') AS TIMESTAMP) AS ts FROM events)""")
def parsed_time_columns(spark, d):
    """Strings by each column's format, under a suffix; what can't be read is null."""
    e = table(spark, d, "events").select("event_id", F.date_format("ts", "dd/MM/yyyy HH.mm.ss").alias("at"), "event_type").withColumnRenamed("event_type", "other")
    out = R.parsed_times(e, {"at": "dd/MM/yyyy HH.mm.ss", "other": "yyyy"}, "_ts")
    return out.select("event_id", F.col("at_ts").cast("timestamp_ntz").alias("at_ts"), F.col("other_ts").cast("timestamp_ntz").alias("other_ts"))


@register("SELECT CAST(n_nationkey AS BIGINT) AS n_nationkey, n_name, CAST(n_regionkey AS VARCHAR) AS n_regionkey, CAST(length(n_name) AS DOUBLE) AS size FROM nation")
def pandas_to_table(spark, d):
    """A small pandas frame by type keywords: a column's own, one of a part of its name, or its dtype's."""
    rows = table(spark, d, "nation").select("n_nationkey", "n_name", F.col("n_regionkey").cast("string"), F.length("n_name").cast("double").alias("size"))
    return io.pandas_to_spark(spark, rows.toPandas(), {"n_regionkey": "str", "key": "long"})
