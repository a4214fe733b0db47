"""Sources and sinks: tables, lexicons, dictionaries, XML and HTML documents, and table maintenance."""

from __future__ import annotations

import string
import tempfile
import uuid
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Type keywords that schema mappings are written in.
TYPE_KEYWORDS: dict[str, T.DataType] = {
    "str": T.StringType(),
    "int": T.IntegerType(),
    "long": T.LongType(),
    "float": T.FloatType(),
    "double": T.DoubleType(),
    "bool": T.BooleanType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "arr[str]": T.ArrayType(T.StringType()),
    "arr[int]": T.ArrayType(T.IntegerType()),
    "arr[long]": T.ArrayType(T.LongType()),
    "arr[float]": T.ArrayType(T.FloatType()),
    "arr[double]": T.ArrayType(T.DoubleType()),
    "arr[bool]": T.ArrayType(T.BooleanType()),
    "map[str,int]": T.MapType(T.StringType(), T.IntegerType()),
    "map[str,str]": T.MapType(T.StringType(), T.StringType()),
}
_PANDAS = {"int64": "long", "int32": "int", "float64": "double", "float32": "float", "bool": "bool"}


def session(app: str = "loomtext", shuffle_partitions: int = 200, **conf) -> SparkSession:
    builder = SparkSession.builder.appName(app).config("spark.sql.shuffle.partitions", shuffle_partitions).config("spark.sql.session.timeZone", "UTC")
    for k, v in conf.items():
        builder = builder.config(k.replace("__", "."), v)
    return builder.getOrCreate()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(spark: SparkSession, sql: str, **args) -> DataFrame:
    """A whole SQL statement, with named arguments bound rather than pasted in."""
    return spark.sql(sql, args=args)


def fill_template(template: str, **values) -> str:
    """Identifiers and the like put into ``{name}``; a missing one is a ValueError."""
    wanted = {f for _, f, _, _ in string.Formatter().parse(template) if f}
    if missing := wanted - values.keys():
        raise ValueError(f"missing: {', '.join(sorted(missing))}")
    return template.format(**values)


def write_table(df: DataFrame, path: str, mode: str = "append", kind: str | None = None, **options) -> None:
    """Sink by kind or by the path's ending (.csv or .parquet, else a ValueError)."""
    kind = kind or path.rsplit(".", 1)[-1].lower()
    if kind not in ("csv", "parquet", "orc", "json"):
        raise ValueError(f"no sink for {path}")
    defaults = {"csv": {"header": "true", "escape": '"'}, "parquet": {"compression": "gzip"}}.get(kind, {})
    df.write.mode(mode).options(**(defaults | options)).format(kind).save(path)


def write_bucketed(df: DataFrame, name: str, buckets: int, *keys: str, **options) -> None:
    """A table whose later joins and groupings on ``keys`` need no shuffle."""
    df.write.mode("overwrite").options(**options).bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(name)


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.csv(path, schema=schema, header=True, multiLine=True, escape='"', encoding="UTF-8")


def scratch(spark: SparkSession, tag: str) -> str:
    """A new folder under ``spark.checkpoint.dir`` (an own one where that is unset), deleted when the driver ends."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        at = tempfile.mkdtemp(prefix="loomtext-")
        spark.conf.set("spark.checkpoint.dir", at)
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{at}/{tag}-{uuid.uuid4().hex}")
    store = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    store.mkdirs(p)
    store.deleteOnExit(p)
    return p.toString()


def truncate_and_load(df: DataFrame, path: str) -> None:
    """Replace all rows of a table."""
    df.write.mode("overwrite").parquet(path)


def merge_into(spark: SparkSession, path: str, new: DataFrame, keys: list[str]) -> None:
    """Rows of ``new`` in place of those of their key, others added. The table is replaced once the merge is written."""
    from ..operators.relational import upsert

    fs_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    store = fs_path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    upsert(spark.read.parquet(path), new, keys).write.mode("overwrite").parquet(f"{path}.merged")
    store.delete(fs_path(path), True)
    if not store.rename(fs_path(f"{path}.merged"), fs_path(path)):
        raise OSError(f"the merged table stays at {path}.merged")


def read_jdbc(spark: SparkSession, url: str, source: str, column: str | None = None, bounds: tuple = (), partitions: int = 8, **options) -> DataFrame:
    """A table or (in parentheses, with a name) a query of a relational database, by ranges of a column if one is given.

    Filters and columns are pushed down by Spark's own source.
    """
    reader = spark.read.format("jdbc").options(url=url, dbtable=source, **options)
    if column:
        reader = reader.options(partitionColumn=column, lowerBound=bounds[0], upperBound=bounds[1], numPartitions=partitions)
    return reader.load()


def read_lexicon(spark: SparkSession, path: str, keep_blank: bool = False) -> DataFrame:
    """(word): trimmed lower-case lines, each once, without blank ones unless those are to be kept."""
    words = spark.read.text(path).select(F.lower(F.trim("value")).alias("word")).distinct()
    return words if keep_blank else words.filter("word <> ''")


def read_counts(spark: SparkSession, path: str, strict: bool = False) -> DataFrame:
    """(word, n) of lines "word count"; malformed lines are left out, or with ``strict`` fail the read."""
    part = F.split(F.trim("value"), r"\s+")
    if strict:
        fine = F.expr("size(split(trim(value), '\\\\s+')) = 2")
        return spark.read.text(path).select(F.when(fine, F.lower(part[0])).otherwise(F.raise_error(F.concat(F.lit("malformed line: "), "value"))).alias("word"), part[1].cast("int").alias("n"))
    rows = spark.read.text(path).filter(F.size(part) == 2)
    return rows.select(F.lower(part[0]).alias("word"), part[1].try_cast("int").alias("n")).filter("n is not null")


def read_contractions(spark: SparkSession, path: str) -> DataFrame:
    """(short, long) of a file that holds one dictionary literal."""
    parsed = F.from_json("value", "map<string,string>", {"allowSingleQuotes": "true"})
    return spark.read.text(path, wholetext=True).select(F.explode(parsed).alias("short", "long"))


def read_files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """Files below a folder as (path, modificationTime, length, content)."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(path)


def pandas_schema(pdf, column_types: dict[str, str | T.DataType] | None = None) -> T.StructType:
    """Exact column name, else a name that contains a mapping's key, else the dtype, else string."""
    mapping = column_types or {}

    def kind(name: str) -> T.DataType:
        chosen = mapping.get(name) or next((v for k, v in mapping.items() if k in name), None)
        if chosen is None:
            dtype = str(pdf[name].dtype)
            chosen = "timestamp" if dtype.startswith("datetime64") else _PANDAS.get(dtype, "str")
        return TYPE_KEYWORDS[chosen] if isinstance(chosen, str) else chosen

    return T.StructType([T.StructField(c, kind(c), True) for c in pdf.columns])


def pandas_to_spark(spark: SparkSession, pdf, column_types=None) -> DataFrame:
    schema = pandas_schema(pdf, column_types)
    return spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None).values.tolist(), schema)


def drop_expired(spark: SparkSession, path: str, on: date, days: int = 30) -> list[str]:
    """Delete the archive folders older than ``days``; their names."""
    fs_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    store = fs_path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    gone = []
    for f in store.listStatus(fs_path(path)):
        name = f.getPath().getName()
        if name.startswith("archive_dt=") and date.fromisoformat(name[11:]) < on - timedelta(days=days):
            store.delete(f.getPath(), True)
            gone.append(name)
    return gone


def empty(spark: SparkSession, schema: str | T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


TRANSCRIPT_SCHEMA = (
    "_id string, _product string, meta struct<title:string, date:string, companies:struct<company:array<string>>,"
    " participants:struct<participant:array<struct<_VALUE:string,_id:string,_type:string,_title:string,_affiliation:string,_entity:string>>>>,"
    " body struct<section:array<struct<_name:string, speaker:array<struct<_id:string, plist:struct<p:array<string>>>>>>>"
)


def parse_transcripts(df: DataFrame, xml: str = "raw_xml") -> DataFrame:
    """Sections and speakers of transcript XML; a document that can't be parsed keeps its row with error = 'yes'.

    Adds title, call_date, management (paragraphs of the discussion section), questions (of the Q&A section) and error.
    """
    doc = F.from_xml(F.col(xml), TRANSCRIPT_SCHEMA, {"rowTag": "transcript", "mode": "PERMISSIVE"})
    df = df.withColumn("doc", doc)

    def paragraphs(name: str) -> Column:
        of_section = F.filter("doc.body.section", lambda s: F.upper(s["_name"]) == name)
        return F.coalesce(F.flatten(F.flatten(F.transform(of_section, lambda s: F.transform(s["speaker"], lambda k: F.coalesce(k["plist"]["p"], F.array().cast("array<string>")))))), F.array().cast("array<string>"))

    out = df.select(*[c for c in df.columns if c != "doc"], F.col("doc.meta.title").alias("title"), F.col("doc.meta.date").alias("call_date"), paragraphs("MANAGEMENT DISCUSSION SECTION").alias("management"), paragraphs("Q&A").alias("questions"), F.when(F.col("doc.body").isNull(), "yes").otherwise("no").alias("error"))
    return out


def archive(df: DataFrame, path: str, on: date) -> None:
    """Daily rows under the folder of the business day before."""
    df.withColumn("archive_dt", F.expr(f"date_sub(date'{on}', if(dayofweek(date'{on}') = 2, 3, 1))")).write.mode("append").partitionBy("archive_dt").parquet(path)


def within_retention(df: DataFrame, on: date, days: int = 30, column: str = "archive_dt") -> DataFrame:
    """Partitions not older than ``days``: a partition filter, so that older ones aren't read."""
    return df.filter(F.col(column) >= F.date_sub(F.lit(on), days))
