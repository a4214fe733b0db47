"""Neighbours of topics, each given by several vectors, and an index of inverted lists for queries that grow.

Topics: inputs are laid in blocks of bounded size, so that a topic may have any number of them. Blocks and parts of the
corpus meet in pairs, one a task, as matrices; products of blocks are multiplied afterwards, and with one block the best
are kept by part before they meet.

Index: a coarse quantiser (k-means of unit vectors, fitted on a bounded sample) puts every vector into a cell; a query
looks into the cells whose centres are nearest. The lists are cut by a hash into parts of bounded size, each with its share
of every list, and blocks of queries meet the parts in pairs; within a pair a list is multiplied with those that look into it.

Defined cases: zero and null vectors have no direction, and are neither inputs nor neighbours; a topic without positive
inputs falls out; inputs are never their topic's neighbours; ties go by id; an empty corpus gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .vectors import BLOCK_QUERIES, PART_ROWS, directions, dot, first_of, in_pairs, matrix, top_pairs, unit

#: Added to the product of the negative inputs.
EPSILON = 0.000001
#: Vectors that the quantiser is fitted on; means that are broadcast.
SAMPLE, BROADCAST_MEANS = 50_000, 16_384


def _best(scored: DataFrame, by: str, k: int) -> DataFrame:
    order = Window.partitionBy(by).orderBy(F.col("score").desc(), "vec_id")
    return scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _products(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """For each row of ``v`` the product of its shifted cosines to the rows of ``q``, in their order, summed as ``dot`` does."""
    out = np.ones(len(v))
    for b in range(0, len(v), 2048):
        some = np.ascontiguousarray(v[b : b + 2048].T)
        for a in range(0, len(q), 32):
            cosines, x = np.zeros((len(q[a : a + 32]), some.shape[1])), np.empty((len(q[a : a + 32]), some.shape[1]))
            for one, other in zip(q[a : a + 32].T, some, strict=True):
                cosines += np.multiply.outer(one, other, out=x)
            for row in cosines:
                out[b : b + 2048] = out[b : b + 2048] * (row + 1) / 2
    return out


def _inputs(inputs: DataFrame) -> DataFrame:
    q = directions(inputs, "vec_id", "topic", "sign")
    return q.join(q.filter("sign > 0").select("topic").distinct(), "topic", "left_semi")


def nearest_by_product(inputs: DataFrame, corpus: DataFrame, k: int = 50) -> DataFrame:
    """(topic, vec_id, score, rank): product of the shifted cosines to positive inputs over that to negative ones.

    ``inputs``: (topic, vec_id, embedding, sign), sign 1 or -1.
    """
    q = _inputs(inputs).select("vec_id", "topic", "sign", "dims", "v")
    pairs, blocks = in_pairs(q, directions(corpus), BLOCK_QUERIES, PART_ROWS)
    kind = q.schema["topic"].dataType
    schema = T.StructType([T.StructField("topic", kind), *T._parse_datatype_string("vec_id long, top double, bottom double, own boolean").fields])

    def run(given, rows):
        found, vec_ids = [], np.asarray(rows.column("vec_id"), np.int64)
        topics = given.column("topic").combine_chunks()
        u, v, ids, sign = matrix(given, "v") if len(given) else None, matrix(rows, "v") if len(rows) else None, np.asarray(given.column("vec_id"), np.int64), np.asarray(given.column("sign"))
        codes = topics.dictionary_encode()
        code = np.asarray(codes.indices)
        for c in range(len(codes.dictionary)) if len(rows) else ():
            of = np.flatnonzero(code == c)
            of = of[np.argsort(ids[of], kind="stable")]
            top, bottom, own = _products(u[of[sign[of] > 0]], v), _products(u[of[sign[of] < 0]], v), np.isin(vec_ids, ids[of])
            kept = np.arange(len(v))
            if blocks == 1:
                kept = np.flatnonzero(~own)
                kept = kept[first_of(np.zeros(len(kept), int), top[kept] / (bottom[kept] + EPSILON), vec_ids[kept], k)]
            found.append(pa.table({"topic": codes.dictionary.take(pa.array(np.full(len(kept), c))), "vec_id": vec_ids[kept], "top": top[kept], "bottom": bottom[kept], "own": own[kept]}))
        return pa.concat_tables(found) if found else pa.table({"topic": topics.slice(0, 0), "vec_id": pa.array([], "int64"), "top": pa.array([], "float64"), "bottom": pa.array([], "float64"), "own": pa.array([], "bool")})

    scored = pairs.applyInArrow(run, schema)
    if blocks > 1:
        scored = scored.groupBy("topic", "vec_id").agg(F.product("top").alias("top"), F.product("bottom").alias("bottom"), F.bool_or("own").alias("own"))
    return _best(scored.filter("not own").select("topic", "vec_id", (F.col("top") / (F.col("bottom") + EPSILON)).alias("score")), "topic", k)


def nearest_by_mean(inputs: DataFrame, corpus: DataFrame, k: int = 50) -> DataFrame:
    """(topic, vec_id, score, rank): cosine to the mean of the inputs' directions, negative ones turned round."""
    q = _inputs(inputs)
    dims = q.select("topic", "sign", F.posexplode("v").alias("dim", "x")).groupBy("topic", "dim").agg(F.avg(F.col("sign") * F.col("x")).alias("m"))
    means = dims.groupBy("topic").agg(unit(F.transform(F.array_sort(F.collect_list(F.struct("dim", "m"))), lambda s: s["m"])).alias("q")).filter("q is not null")
    n = means.count()
    met = directions(corpus).join(F.broadcast(means) if n <= BROADCAST_MEANS else means.hint("shuffle_replicate_nl"))
    scored = met.select("topic", "vec_id", dot(F.col("q"), F.col("v")).alias("score"))
    return _best(scored.join(q.select("topic", "vec_id").hint("merge"), ["topic", "vec_id"], "left_anti"), "topic", k)


class InvertedLists:
    """An index of ``corpus`` (vec_id, embedding): every vector in the list of its cell."""

    def __init__(self, corpus: DataFrame, cells: int = 64, seed: int = 17):
        rows = directions(corpus)
        n = max(rows.count(), 1)
        share = F.pmod(F.xxhash64(F.lit(seed), "vec_id"), F.lit(1 << 20)) < F.lit(int((1 << 20) * min(1.0, SAMPLE / n)))
        vectors = rows.withColumn("features", array_to_vector("v"))
        sample = vectors.filter(share)
        self.empty = sample.isEmpty()
        if self.empty:
            return
        model = KMeans(k=cells, seed=seed, maxIter=10, predictionCol="cell").fit(sample)
        centres = [(i, c.tolist()) for i, c in enumerate(model.clusterCenters())]
        spark, self.cells = corpus.sparkSession, len(centres)
        self.centres = spark.createDataFrame(centres, "cell int, centre array<double>")
        self.lists = model.transform(vectors).select("vec_id", "dims", "v", "cell")

    def nearest(self, queries: DataFrame, k: int, probes: int = 16) -> DataFrame:
        """(query_id, vec_id, score, rank) from the ``probes`` nearest cells of each query; queries are shuffled, not broadcast.

        A list or a query of another length than the centres' has no cosine to them, and no neighbours.
        """
        if self.empty:
            return queries.sparkSession.createDataFrame([], "query_id long, vec_id long, score double, rank int")
        q = directions(queries, "query_id")
        centres = self.centres.agg(F.collect_list(F.struct("cell", "centre")).alias("centres"))
        near = F.transform("centres", lambda c: F.struct((-dot(F.col("v"), c["centre"])).alias("far"), c["cell"].alias("cell")))
        asked = q.join(F.broadcast(centres)).select("query_id", "dims", "v", F.slice(F.array_sort(near), 1, probes)["cell"].alias("cells"))  # one row
        pairs, _ = in_pairs(asked, self.lists, BLOCK_QUERIES, PART_ROWS)
        n = self.cells

        def run(some, rows):
            if not len(some) or not len(rows):
                return pa.table({"query_id": pa.array([], "int64"), "vec_id": pa.array([], "int64"), "score": pa.array([], "float64")})
            rows = rows.sort_by("cell")
            ids, vec_ids, lists = np.asarray(some.column("query_id")), np.asarray(rows.column("vec_id")), some.column("cells").combine_chunks()
            looks = np.zeros((len(ids), n), bool)
            looks[np.asarray(lists.value_parent_indices()), np.asarray(lists.flatten())] = True
            i, j, cosine = top_pairs(ids, matrix(some, "v"), vec_ids, matrix(rows, "v"), k, np.asarray(rows.column("cell")), looks)
            return pa.table({"query_id": ids[i], "vec_id": vec_ids[j], "score": cosine})

        return _best(pairs.applyInArrow(run, "query_id long, vec_id long, score double"), "query_id", k)
