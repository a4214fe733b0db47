"""Known pairs against a plain reading of the rule; neighbours against numpy; recall of the index."""

from __future__ import annotations

import random
import time

import numpy as np
from pyspark.sql import functions as F

from loomtext.operators import neighbours as N
from loomtext.operators import phrases as P


def by_the_rule(words, known):
    out, pairs = list(words), []
    for a, b in zip(words, words[1:], strict=False):
        if f"{a}_{b}" in known:
            if not pairs:
                out.remove(a)
            out.remove(b)
            pairs.append(f"{a}_{b}")
    return out + pairs


def test_pairs(spark):
    assert by_the_rule("new york city new york".split(), {"new_york", "york_city"}) == ["new", "new_york", "york_city", "new_york"]
    rng = random.Random(3)
    known = {"a_b", "b_c", "c_c", "d_a", "b_b"}
    rows = [(i, [rng.choice("abcde") for _ in range(rng.randint(0, 12))]) for i in range(300)] + [(300, None)]
    df, table = spark.createDataFrame(rows, "k long, w array<string>"), spark.createDataFrame([(x,) for x in sorted(known)] * 2 + [(None,)], "pair string")
    got = {}
    for r in sorted(P.substituted(df, "w", table, "k").collect()):
        got.setdefault(r.k, []).append(r.gram)
    assert got == {k: by_the_rule(w, known) for k, w in rows if w}
    none = P.substituted(df, "w", table.limit(0), "k").count()
    assert none == sum(len(w) for _, w in rows if w)


def test_pairs_within_sentences_are_not_shuffled(spark, monkeypatch):
    """Sentences of texts by both ways: given to every task, and by shuffled joins."""
    rng = random.Random(4)
    docs = [[[rng.choice("abcdE") for _ in range(rng.randint(0, 9))] for _ in range(rng.randint(1, 5))] for _ in range(200)] + [[[]], [["a", "b", "a", "b"]]]
    texts = [". ".join(map(" ".join, d)) for d in docs] + [None]
    known = {"a_b", "b_c", "c_c", "d_a", "b_b"}
    df, table = spark.createDataFrame(list(enumerate(texts)), "k long, text string"), spark.createDataFrame([(x,) for x in sorted(known)] * 2 + [(None,)], "pair string")
    want = {(k, i): " ".join(by_the_rule([w.lower() for w in x], known)) for k, d in enumerate(docs) for i, x in enumerate(d) if x}
    for most in (1 << 22, 0):
        monkeypatch.setattr(P, "MAX_KNOWN", most)
        got = P.substituted_sentences(df, "text", table, "k")
        assert {(r.k, r.sent_idx): r.grams for r in got.collect()} == want
        p = got._jdf.queryExecution().optimizedPlan().toString()
        assert ("Join" in p or "Aggregate" in p) == (most == 0)
    monkeypatch.setattr(P, "MAX_KNOWN", 1 << 22)
    assert "Join" not in P.substituted(df.select("k", F.split("text", " ").alias("w")), "w", table, "k")._jdf.queryExecution().optimizedPlan().toString()


def test_pairs_of_a_long_row(spark):
    rng = random.Random(1)
    words = [rng.choice(["x", "y", "z"]) for _ in range(100_000)]
    df, table = spark.createDataFrame([(1, words)], "k long, w array<string>"), spark.createDataFrame([("x_y",), ("y_z",)], "pair string")
    start = time.time()
    n = P.substituted(df, "w", table, "k").count()
    known = sum(p in ("x_y", "y_z") for p in (f"{a}_{b}" for a, b in zip(words, words[1:], strict=False)))
    assert n == len(words) - 1 and known and time.time() - start < 30


def test_embedded_phrases(spark):
    vectors = spark.createDataFrame([("strong", [1.0, 0.0]), ("demand", [0.0, 1.0]), ("weak_demand", [5.0, 5.0]), ("weak", [9.0, 9.0])], "word string, vector array<double>")
    phrases = spark.createDataFrame([("strong demand",), ("weak demand",), ("weak_demand",), ("very weak demand strong",), ("none",), (None,)], "phrase string")
    got = {r.phrase: r.vector for r in P.embedded(phrases, vectors).collect()}
    assert got == {"strong demand": [0.5, 0.5], "weak demand": [5.0, 5.0], "weak_demand": [5.0, 5.0], "very weak demand strong": [3.0, 2.5], "none": None}


def vectors_of(spark, n, dims=16, seed=5):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, dims))
    v = centres[rng.integers(0, 12, n)] + 0.5 * rng.normal(size=(n, dims))
    return v, spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<double>")


def test_topics_of_many_inputs(spark, monkeypatch):
    monkeypatch.setattr(N, "BLOCK_QUERIES", 4)
    v, df = vectors_of(spark, 200)
    u = v / np.linalg.norm(v, axis=1, keepdims=True)
    plus, minus = list(range(0, 14)), [20, 21]
    rows = [("t", i, v[i].tolist(), 1 if i in plus else -1) for i in plus + minus] + [("only against", 3, v[3].tolist(), -1), ("t", 500, [0.0] * 16, 1)]
    inputs = spark.createDataFrame(rows, "topic string, vec_id long, embedding array<double>, sign int")
    sims = (1 + u @ u.T) / 2
    product = sims[:, plus].prod(axis=1) / (sims[:, minus].prod(axis=1) + N.EPSILON)
    mean = u[plus].sum(axis=0) - u[minus].sum(axis=0)
    for got, score in ((N.nearest_by_product(inputs, df, 20), product), (N.nearest_by_mean(inputs, df, 20), u @ (mean / np.linalg.norm(mean)))):
        rows = sorted(got.collect(), key=lambda r: r["rank"])
        want = [i for i in np.argsort(-score) if i not in plus + minus][:20]
        assert [r.vec_id for r in rows] == want and {r.topic for r in rows} == {"t"}
        assert np.allclose([r.score for r in rows], score[want])


def test_recall_of_the_index(spark, monkeypatch):
    monkeypatch.setattr(N, "PART_ROWS", 50)
    v, df = vectors_of(spark, 3000)
    u = v / np.linalg.norm(v, axis=1, keepdims=True)
    sims = u @ u.T
    np.fill_diagonal(sims, -2)
    best = {i: set(np.argsort(-sims[i])[:10]) for i in range(3000)}
    found = {}
    for r in N.InvertedLists(df, cells=32).nearest(df, 10, probes=8).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    assert sum(len(best[i] & found[i]) for i in best) / 30_000 >= 0.9
    assert N.InvertedLists(df.limit(0)).nearest(df, 10).count() == 0


def test_recall_over_the_given_vectors(spark):
    from loomtext.plans.neighbours import neighbours_by_index

    sf = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding").collect()
    ids, u = [r.vec_id for r in rows], np.array([r.embedding for r in rows], float)
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    sims = u @ u.T
    np.fill_diagonal(sims, -2)
    found = {}
    for r in neighbours_by_index(spark, sf).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    hits = sum(len({ids[j] for j in np.argsort(-sims[i])[:10]} & found[ids[i]]) for i in range(len(ids)))
    assert hits / (10 * len(ids)) >= 0.9


def test_best_of_many_copies_and_odd_vectors(spark, monkeypatch):
    """Blocks and parts of a few rows give the plain result: copies tie by id, no direction or another length is no neighbour."""
    from loomtext.operators import vectors as V

    v, _ = vectors_of(spark, 300)
    rows = [(i, v[i % 120].tolist()) for i in range(300)] + [(900, [0.0] * 16), (901, None), (902, [1.0, 2.0]), (903, [None] * 16)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    u = v[np.arange(300) % 120] / np.linalg.norm(v[np.arange(300) % 120], axis=1, keepdims=True)
    sims = np.round(u @ u.T, 12)
    for part in (40, 65_536):
        monkeypatch.setattr(V, "PART_ROWS", part)
        got = {}
        for r in V.nearest(df.filter("vec_id % 50 = 0"), df, 10).collect():
            got.setdefault(r.query_id, []).append((r["rank"], r.vec_id))
        assert {q: [i for _, i in sorted(x)] for q, x in got.items()} == {q: [i for i in np.lexsort((np.arange(300), -sims[q])) if i != q][:10] for q in range(0, 300, 50)}


def test_searches_keep_pairs_out_of_rows(spark, tmp_path):
    """Pairs are never rows: what is shuffled stays near the input, where each pair was once scored as a row of Spark's."""
    from loomtext.operators import vectors as V

    v, df = vectors_of(spark, 4000, dims=64)
    start = time.time()
    assert V.nearest(df, df, 5).count() == 20_000
    assert time.time() - start < 40
