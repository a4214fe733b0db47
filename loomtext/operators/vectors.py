"""Vectors: means, word vectors, nearest neighbours."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import with_value
from ..sources.io import scratch


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def unit(v: Column) -> Column:
    """The vector at length 1; null for a zero vector."""
    return with_value(F.sqrt(dot(v, v)), lambda norm: F.when(norm > 0, F.transform(v, lambda x: x.cast("double") / norm)))


def directions(df: DataFrame, name: str = "vec_id", *others: str) -> DataFrame:
    """(name, others, dims, v) of the rows whose ``embedding`` has a direction."""
    e = F.col("embedding")
    return df.filter(dot(e, e) > 0).select(F.col("vec_id").cast("long").alias(name), *others, F.size(e).alias("dims"), unit(e).alias("v"))


def mean_vector(df: DataFrame, vector: str, *by: str) -> DataFrame:
    """(by, dim, mean): a row for each dimension, so that partial sums are combined before the shuffle."""
    return df.select(*by, F.posexplode(vector).alias("dim", "x")).groupBy(*by, "dim").agg(F.avg(F.col("x").cast("double")).alias("mean"))


def mean_of_words(docs: DataFrame, words: str, table: DataFrame, key: str) -> DataFrame:
    """(key, vector): mean vector of the words that ``table`` (word, vector) knows; documents without such fall out."""
    rows = docs.select(key, F.explode(words).alias("word")).join(table, "word").select(key, F.posexplode("vector").alias("dim", "x"))
    means = rows.groupBy(key, "dim").agg(F.avg("x").alias("m"))
    return means.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("dim", "m"))), lambda s: s["m"]).alias("vector"))


#: Queries to a block and rows to a part of the corpus, at most; numbers to either (32 MB), which bounds them for long vectors.
BLOCK_QUERIES, PART_ROWS, SIDE_NUMBERS = 65_536, 65_536, 1 << 22
#: Pairs of a block and a part that are asked for where there are rows enough for them.
LEAST_GROUPS = 32


def in_pairs(left: DataFrame, right: DataFrame, left_rows: int, right_rows: int):
    """Both frames of :func:`directions`, each row in its block of ``left`` or part of ``right`` and there once for every one of the other side,
    grouped by both and by the vectors' length; and the number of blocks.

    A group is bounded by ``left_rows``, ``right_rows`` and SIDE_NUMBERS, so a task's memory doesn't grow with the tables.
    """
    (n, dims), (m, width) = (df.agg(F.count(F.lit(1)), F.max("dims")).first() for df in (left, right))
    most = max(1, SIDE_NUMBERS // max(dims or 1, width or 1))
    blocks, parts = max(1, -(-n // min(left_rows, most))), max(1, -(-m // min(right_rows, most)))
    while blocks * parts < LEAST_GROUPS and m / parts > 1024:
        parts *= 2

    def dealt(df: DataFrame, key: str, name: str, k: int, other: str, j: int) -> DataFrame:
        own = F.pmod(F.xxhash64(key), F.lit(k)).cast("int").alias(name)
        rows = df.select("*", own, F.explode(F.sequence(F.lit(0), F.lit(j - 1))).alias(other))
        keys = ("dims", "block", "part")
        return rows.repartition(min(blocks * parts, 2048), *keys).groupBy(*keys)

    return dealt(left, left.columns[0], "block", blocks, "part", parts).cogroup(dealt(right, right.columns[0], "part", parts, "block", blocks)), blocks


def matrix(rows, name: str) -> np.ndarray:
    """A list column of an Arrow table, its lists of one length, as rows of a matrix."""
    column = rows.column(name).combine_chunks()
    return np.asarray(column.flatten(), float).reshape(len(column), -1)


def first_of(group: np.ndarray, score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of each group's k rows of highest score, ties by id; NaN is above all numbers, as in Spark."""
    order = np.lexsort((ids, -np.nan_to_num(score, nan=np.inf, posinf=np.inf, neginf=-np.inf), ~np.isnan(score), group))
    sorted_group = group[order]
    start = np.searchsorted(sorted_group, sorted_group)
    return order[np.arange(len(order)) - start < k]


def top_pairs(ids: np.ndarray, q: np.ndarray, vec_ids: np.ndarray, v: np.ndarray, k: int, cells: np.ndarray | None = None, probes: np.ndarray | None = None, rows: int = 64):
    """(places in ids, places in vec_ids, cosine) of each query's k best rows of ``v`` but itself.

    Products in single precision tell what may be among the best, with their error allowed for; the cosines of those are
    then summed in double precision in the order of :func:`dot`. ``cells`` (ascending) and ``probes`` (a row of flags by
    cell for each query): only rows of a query's own cells count.
    """
    slack = np.float32(1e-6 * max(q.shape[1], 8))
    q32, v32 = q.astype(np.float32), v.astype(np.float32)
    finite = np.isfinite(q32).all() and np.isfinite(v32).all()
    bounds = None if cells is None else np.searchsorted(cells, np.arange(probes.shape[1] + 1))
    out = []
    for a in range(0, len(q), rows):
        mine = ids[a : a + rows]
        if bounds is None:
            s = q32[a : a + rows] @ v32.T
        else:
            s = np.full((len(mine), len(v)), -np.inf, np.float32)
            for c in range(probes.shape[1]):
                at = np.flatnonzero(probes[a : a + rows, c])
                if len(at) and bounds[c] < bounds[c + 1]:
                    s[at, bounds[c] : bounds[c + 1]] = q32[a + at] @ v32[bounds[c] : bounds[c + 1]].T
        if not finite:
            s[np.isnan(s)] = np.inf
        same = np.flatnonzero(np.isin(vec_ids, mine))
        s[:, same] = np.where(mine[:, None] == vec_ids[same], -np.inf, s[:, same])
        # The k-th of the greatest of many strips is never above the k-th of all.
        strips, deep = max(256, 8 * k), len(v) // max(256, 8 * k)
        some = s[:, : strips * deep].reshape(len(mine), deep, strips).max(axis=1) if deep > 1 else s
        least = np.partition(some, some.shape[1] - k, axis=1)[:, some.shape[1] - k] if some.shape[1] > k else np.full(len(mine), -np.inf, np.float32)
        i, j = np.nonzero((s >= (least - slack)[:, None]) & (s > -np.inf))
        if len(i):
            exact = np.concatenate([np.add.accumulate(q[a + i[b : b + 65_536]] * v[j[b : b + 65_536]], axis=1)[:, -1] for b in range(0, len(i), 65_536)])
            best = first_of(i, exact, vec_ids[j], k)
            out.append((a + i[best], j[best], exact[best]))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True)) if out else (np.zeros(0, int), np.zeros(0, int), np.zeros(0))


def nearest(queries: DataFrame, corpus: DataFrame, k: int) -> DataFrame:
    """The k rows of ``corpus`` (vec_id, embedding) of highest cosine for each of a stated set of queries.

    Blocks of queries and parts of the corpus meet in pairs, each multiplied as matrices within a task, which keeps each
    query's best k of the part before the parts meet. Vectors of other lengths are no neighbours.
    """
    pairs, _ = in_pairs(directions(queries, "query_id"), directions(corpus), BLOCK_QUERIES, PART_ROWS)

    def run(asked, rows):
        ids, vec_ids = (np.asarray(t.column(n)) for t, n in ((asked, "query_id"), (rows, "vec_id")))
        if not len(ids) or not len(vec_ids):
            return pa.table({"query_id": pa.array([], "int64"), "vec_id": pa.array([], "int64"), "cosine": pa.array([], "float64")})
        i, j, cosine = top_pairs(ids, matrix(asked, "v"), vec_ids, matrix(rows, "v"), k)
        return pa.table({"query_id": ids[i], "vec_id": vec_ids[j], "cosine": cosine})

    scored = pairs.applyInArrow(run, "query_id long, vec_id long, cosine double")
    best = Window.partitionBy("query_id").orderBy(F.col("cosine").desc(), "vec_id")
    return scored.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)


def multiplicative_cosine(positive: list[Column], negative: list[Column]) -> Column:
    """Product of the (shifted) cosines to the positive words over that to the negative ones."""
    shift = lambda c: (c + 1) / 2
    top, bottom = F.lit(1.0), F.lit(1.0)
    for c in positive:
        top = top * shift(c)
    for c in negative:
        bottom = bottom * shift(c)
    return top / (bottom + 0.000001)


def bigram_phrases(tokens: DataFrame, min_count: int, threshold: float) -> DataFrame:
    """(first, second, n, score) of word pairs whose score (n - min_count) * vocabulary / (n_a * n_b) is over the threshold.

    ``tokens``: (words) arrays of words; null or an empty string is no word and ends a sentence, as the array's end does.

    Each word is counted with the one that follows it, or none. What stands under ``min_count`` times is then put together
    by first word, so that words' counts are sums of these and texts are read once; both are written once and read back.
    """
    spark, path = tokens.sparkSession, scratch(tokens.sparkSession, "pairs")

    def written(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{path}/{name}")
        return spark.read.schema(df.schema).parquet(f"{path}/{name}")

    after = tokens.select("words", F.slice("words", F.lit(2), F.greatest(F.size("words"), F.lit(1))).alias("rest"))
    each = after.select(F.inline(F.arrays_zip("words", "rest"))).toDF("first", "second").filter("first <> ''")
    counts = each.groupBy("first", F.nullif("second", F.lit("")).alias("second")).agg(F.count(F.lit(1)).alias("n"))
    counts = written(counts.groupBy("first", F.when(F.col("n") >= min_count, F.col("second")).alias("second")).agg(F.sum("n").alias("n")), "counts")
    words = written(counts.groupBy("first").agg(F.sum("n").alias("n_a")), "words")
    size = words.agg(F.count(F.lit(1)).alias("vocabulary"))
    score = lambda n_b: (F.col("n") - min_count) * F.col("vocabulary") / (F.col("n_a") * F.col(n_b))
    # The second word stands n times at least: a pair that isn't over the threshold by n isn't by that word's count.
    some = counts.filter("second is not null").join(words, "first").crossJoin(F.broadcast(size)).filter(score("n") > threshold)
    out = some.join(words.toDF("second", "n_b"), "second")
    return out.select("first", "second", "n", "n_a", "n_b", "vocabulary", score("n_b").alias("score")).filter(F.col("score") > threshold)


def train_word2vec(docs: DataFrame, words: str, size: int = 300, window: int = 5, min_count: int = 10, epochs: int = 15, seed: int = 42, partitions: int = 8):
    """Word2Vec of arrays of words. The model holds the words that stand ``min_count`` times; partitions are averaged."""
    from pyspark.ml.feature import Word2Vec

    return Word2Vec(vectorSize=size, windowSize=window, minCount=min_count, maxIter=epochs, seed=seed, numPartitions=partitions, inputCol=words, outputCol="vector").fit(docs)


def embedded_phrases(phrases: DataFrame, table: DataFrame) -> DataFrame:
    """(phrase, vector): the phrase's own vector (words joined by _), else the mean of its words'; null for neither."""
    own = table.select(F.col("word").alias("own_word"), F.col("vector").alias("own"))
    means = mean_of_words(phrases.select("phrase", F.split(F.lower("phrase"), " ").alias("w")), "w", table, "phrase").withColumnRenamed("vector", "mean")
    out = phrases.join(own, F.replace(F.lower("phrase"), F.lit(" "), F.lit("_")) == F.col("own_word"), "left").join(means, "phrase", "left")
    return out.select("phrase", F.coalesce("own", "mean").alias("vector"))
