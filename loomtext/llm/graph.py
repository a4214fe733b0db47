"""Connected components of a graph kept as a table of links."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import forget, materialize

MAX_ROUNDS = 60


class UnionFind:
    """Disjoint sets of integers; the smallest member stands for its set."""

    def __init__(self):
        self.parent: dict[int, int] = {}

    def find(self, x: int) -> int:
        parent = self.parent
        root = x
        while (up := parent.get(root, root)) != root:
            root = up
        while x != root:
            parent[x], x = root, parent.get(x, x)
        return root

    def union(self, a: int, b: int) -> None:
        a, b = self.find(a), self.find(b)
        if a != b:
            self.parent[max(a, b)] = min(a, b)


def _forest(batches):
    """A partition's links as a spanning forest of stars (node, root): never more rows than nodes."""
    sets = UnionFind()
    for b in batches:
        for x, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            sets.union(x, y)
    nodes = np.fromiter(sets.parent, np.int64, len(sets.parent))
    roots = np.array([sets.find(x) for x in nodes.tolist()], np.int64)
    for at in range(0, len(nodes), 65_536):
        yield pa.RecordBatch.from_arrays([pa.array(roots[at : at + 65_536]), pa.array(nodes[at : at + 65_536])], ["a", "b"])


def _both(links: DataFrame) -> DataFrame:
    return links.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(links.select(F.col("b").alias("u"), F.col("a").alias("v")))


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b: long); the root is the component's smallest node.

    Each partition first joins its own links by union-find. Then large-star and small-star steps alternate until the
    links are stars around the roots; every step is aggregated before it is shuffled, and written.
    """
    links = links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a < b")
    edges = materialize(links.mapInArrow(_forest, "a long, b long"), "cc")
    state = None
    for _ in range(MAX_ROUNDS):
        both = _both(edges)
        small = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(small, "u").filter("v > u").select(F.col("m").alias("a"), F.col("v").alias("b")).distinct()
        large = materialize(large, "cc")
        # Links to smaller nodes only: (u, v) with v < u.
        low = large.groupBy(F.col("b").alias("u")).agg(F.min("a").alias("m"))
        moved = large.join(low, large["b"] == low["u"]).select(F.col("m").alias("a"), F.col("a").alias("b")).filter("a < b")
        after = materialize(moved.unionByName(low.select(F.col("m").alias("a"), F.col("u").alias("b"))).distinct(), "cc")
        forget(edges)
        forget(large)
        edges = after
        now = tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == state:
            break
        state = now
    else:
        raise RuntimeError("components didn't settle")
    roots = edges.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct()
    return edges.select(F.col("b").alias("node"), F.col("a").alias("root")).unionByName(roots)
