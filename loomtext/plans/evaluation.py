"""Queries over predictions, vectors and streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import evaluate as E
from ..operators import vectors as V
from ..sources.io import scratch, table
from ..streaming import jobs
from .base import register

#: A rule stands in for a model's predictions: texts of over 1000 characters are taken for good ones.
SQL_PRED = "pred AS (SELECT doc_id, lang, quality AS truth, CAST(n_chars > 1000 AS INTEGER) AS predicted, (n_chars % 997) / 997.0 AS score FROM documents JOIN labels USING (doc_id))"


def predictions(spark, d):
    j = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id")
    return j.select("doc_id", "lang", F.col("quality").alias("truth"), (F.col("n_chars") > 1000).cast("int").alias("predicted"), ((F.col("n_chars") % 997) / 997.0).alias("score"))


_COUNTS = "count(*) FILTER (truth = 1 AND predicted = 1) AS tp, count(*) FILTER (truth = 0 AND predicted = 1) AS fp, count(*) FILTER (truth = 1 AND predicted = 0) AS fn, count(*) FILTER (truth = 0 AND predicted = 0) AS tn"


@register(f"WITH {SQL_PRED} SELECT lang, {_COUNTS} FROM pred GROUP BY lang")
def confusion_by_group(spark, d):
    """A13."""
    return E.confusion(predictions(spark, d), "truth", "predicted", "lang")


@register(f"""WITH {SQL_PRED}, c AS (SELECT lang, {_COUNTS} FROM pred GROUP BY lang) SELECT lang, coalesce((tp + tn) / nullif(tp + fp + fn + tn, 0), 0) AS accuracy, coalesce(tp / nullif(tp + fp, 0), 0) AS precision,
 coalesce(tp / nullif(tp + fn, 0), 0) AS recall, coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0) AS f1 FROM c""")
def prf_metrics(spark, d):
    """A14, A16, M19."""
    return E.rates(E.confusion(predictions(spark, d), "truth", "predicted", "lang")).select("lang", "accuracy", "precision", "recall", "f1")


@register(f"WITH {SQL_PRED} SELECT CAST(t AS DOUBLE) AS threshold, avg(CAST((score > t) = (truth = 1) AS INTEGER)) AS accuracy FROM pred, (VALUES (0.25), (0.5), (0.75)) v(t) GROUP BY t")
def accuracy_at_thresholds(spark, d):
    """A15."""
    return E.accuracy_at(predictions(spark, d), "truth", "score", [0.25, 0.5, 0.75])


@register(f"WITH {SQL_PRED} SELECT lang, CAST(t AS DOUBLE) AS threshold, avg(CAST(score < t AS INTEGER)) AS share FROM pred, (VALUES (0.1), (0.5), (0.9)) v(t) GROUP BY lang, t")
def score_shares(spark, d):
    """A17."""
    return E.share_below(predictions(spark, d), "score", [0.1, 0.5, 0.9], "lang")


@register(f"""WITH {SQL_PRED}, r AS (SELECT truth, (2 * rank() OVER (ORDER BY score) - 1 + count(*) OVER (PARTITION BY score)) / 2 AS rk FROM pred)
 SELECT (sum(rk) FILTER (truth = 1) - count(*) FILTER (truth = 1) * (count(*) FILTER (truth = 1) + 1) / 2) / (count(*) FILTER (truth = 1) * count(*) FILTER (truth = 0)) AS auc FROM r""")
def roc_auc(spark, d):
    """A14, W10."""
    return E.roc_auc(predictions(spark, d), "truth", "score")


@register("""WITH r AS (SELECT (2 * rank() OVER (ORDER BY l_quantity) - 1 + count(*) OVER (PARTITION BY l_quantity)) / 2 AS ra, (2 * rank() OVER (ORDER BY l_extendedprice) - 1 + count(*) OVER (PARTITION BY l_extendedprice)) / 2 AS rb FROM lineitem)
 SELECT round(corr(ra, rb), 9) AS rho, count(*) AS n FROM r""")
def spearman(spark, d):
    """A20."""
    return E.spearman(table(spark, d, "lineitem"), "l_quantity", "l_extendedprice").select(F.round("rho", 9).alias("rho"), "n")


def sql_percent(key: str) -> str:
    return f"CAST('0x' || substr(md5('42|' || {key}), 1, 8) AS BIGINT) % 100"


@register(f"SELECT conv_id, turn, CASE WHEN {sql_percent('conv_id')} < 80 THEN 'train' ELSE 'test' END AS part FROM conversations")
def group_split(spark, d):
    """M26."""
    return E.group_split(table(spark, d, "conversations").select("conv_id", "turn"), F.col("conv_id"))


@register(f"""SELECT doc_id, CASE WHEN quality = 1 THEN 'entailment' ELSE 'not_entailment' END AS label, CASE WHEN {sql_percent("doc_id || '|' || quality")} < 80 THEN 'train' ELSE 'test' END AS part FROM labels WHERE quality IS NOT NULL""")
def row_split(spark, d):
    """Labels are derived, rows without one fall out, and each row goes by itself."""
    rows = table(spark, d, "labels").filter("quality is not null")
    label = F.when(F.col("quality") == 1, "entailment").otherwise("not_entailment")
    return E.row_split(rows, "doc_id", "quality").select("doc_id", label.alias("label"), "part")


@register(f"""WITH {SQL_PRED}, c AS (SELECT lang, class, count(*) FILTER (truth = class AND predicted = class) AS tp, count(*) FILTER (truth <> class AND predicted = class) AS fp, count(*) FILTER (truth = class AND predicted <> class) AS fn
 FROM pred, (VALUES (0), (1)) v(class) GROUP BY lang, class) SELECT lang, CAST(class AS INTEGER) AS class, coalesce(tp / nullif(tp + fp, 0), 0) AS precision, coalesce(tp / nullif(tp + fn, 0), 0) AS recall, coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0) AS f1, tp + fn AS support FROM c""")
def class_report(spark, d):
    """Every class, with support, by group."""
    return E.class_report(predictions(spark, d), "truth", "predicted", [0, 1], "lang")


@register("SELECT label, CAST(dim - 1 AS INTEGER) AS dim, round(avg(CAST(x AS DOUBLE)), 9) AS mean FROM (SELECT label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS dim FROM embeddings) GROUP BY label, dim")
def mean_embedding_by_label(spark, d):
    """M21."""
    return V.mean_vector(table(spark, d, "embeddings"), "embedding", "label").select("label", "dim", F.round("mean", 9).alias("mean"))


@register("""WITH u AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings), c AS (SELECT q.vec_id AS query_id, v.vec_id, list_cosine_similarity(q.e, v.e) AS cosine FROM u q JOIN u v ON q.vec_id <> v.vec_id WHERE q.vec_id % 50 = 0)
 SELECT query_id, vec_id, round(cosine, 9) AS cosine FROM c QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY cosine DESC, vec_id) <= 10""")
def topk_cosine(spark, d):
    """The stated query set is every fiftieth vector."""
    e = table(spark, d, "embeddings")
    return V.nearest(e.filter("vec_id % 50 = 0"), e, 10).select("query_id", "vec_id", F.round("cosine", 9).alias("cosine"))


@register("SELECT event_id, user_id, event_type FROM events")
def stream_dedupe_append(spark, d):
    """A stream over the table, each event once, appended to a history that is then read."""
    folder = scratch(spark, "stream")
    schema = table(spark, d, "events").schema
    events = jobs.stream_table(spark, d, "events.parquet", schema).select("event_id", "user_id", "event_type")
    jobs.append_new(events, f"{folder}/out", ["event_id"], f"{folder}/state").awaitTermination()
    return spark.read.parquet(f"{folder}/out")


@register("""SELECT time_bucket(INTERVAL 1 DAY, ts) AS start, event_type, count(*) AS n, CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS cents FROM events GROUP BY ALL""")
def window_tumbling(spark, d):
    """Extension: the batch form of the streaming window."""
    w = F.window(F.col("ts").cast("timestamp"), "1 day")
    g = table(spark, d, "events").groupBy(w.alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum(F.round(F.col("value") * 100).cast("long")).alias("cents"))
    return g.select(F.col("w.start").cast("timestamp_ntz").alias("start"), "event_type", "n", "cents")


@register("""WITH m AS (SELECT user_id, ts, CASE WHEN lag(ts) OVER w IS NULL OR ts >= lag(ts) OVER w + INTERVAL 1 DAY THEN 1 ELSE 0 END AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
 s AS (SELECT user_id, ts, sum(new) OVER (PARTITION BY user_id ORDER BY ts RANGE UNBOUNDED PRECEDING) AS sid FROM m) SELECT user_id, min(ts) AS start, count(*) AS n FROM s GROUP BY user_id, sid""")
def window_session(spark, d):
    """Extension: sessions by a gap of a day."""
    g = table(spark, d, "events").withColumn("at", F.col("ts").cast("timestamp")).groupBy(F.session_window("at", "1 day").alias("w"), "user_id").agg(F.count(F.lit(1)).alias("n"))
    return g.select("user_id", F.col("w.start").cast("timestamp_ntz").alias("start"), "n")
