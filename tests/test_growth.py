"""Steps whose cost once grew faster than the input: what they do, told by plans and by what a task is given."""

from __future__ import annotations

from datetime import date, timedelta

import numpy as np
from pyspark.sql import functions as F

from loomtext.functions import arrow_text as A
from loomtext.functions import text as X
from loomtext.operators import dictionaries as D
from loomtext.operators import evaluate, models
from loomtext.operators import relational as R
from loomtext.operators import vectors as V
from loomtext.plans import defined, textual
from loomtext.streaming import jobs


def plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_tokens_need_no_table_of_letters(spark):
    """Letters beyond ASCII part words, also those whose lower case is within it."""
    df = spark.createDataFrame([("The KING\u212Aing \u0130st \u00C9tat, a-B_c9D\n",), ("",), (None,)], "text string").select(X.tokens(F.col("text")).alias("w"))
    assert "translate(" not in plan(df)
    assert [r.w for r in df.collect()] == [["the", "king", "ing", "st", "tat", "a", "b", "c", "d"], [], None]


def test_texts_are_cleaned_once(spark):
    p = spark.createDataFrame([("Don't a CAN",), (" ",), (None,)], "text string").select(X.preprocessed(F.col("text"), {"Don't": "do not"}, ("can",), {"not": "nay"}).alias("p"))
    assert plan(p).count("regexp_replace(") == 1
    assert [tuple(r.p) for r in p.collect()] == [("do not can", ["do", "nay"], 2), (None, [], 0), (None, [], 0)]


def test_state_is_shared_by_entities(spark, tmp_path, monkeypatch):
    """All entities in one key of the state: each has its own counts, and one that is over leaves the others there."""
    monkeypatch.setattr(jobs, "COVERAGE_KEYS", 1)
    day = lambda k: date(2020, 1, 1) + timedelta(k)
    for rows in ([(1, day(0), 1, 1), (2, day(0), 1, 0), (None, day(1), 1, 1)], [(2, day(3), 2, 1), (3, day(40), 1, 1)], [(3, day(41), 2, 0)]):
        spark.createDataFrame(rows, "entity long, day date, version long, flag int").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        stream = jobs.coverage_changes(jobs.stream_table(spark, f"{tmp_path}/in", "*.parquet", spark.read.parquet(f"{tmp_path}/in").schema), 5, "30 days")
        jobs.appended(stream, f"{tmp_path}/out", f"{tmp_path}/state").awaitTermination()
    got = {}
    for r in spark.read.parquet(f"{tmp_path}/out").collect():
        c, f = got.get((r.entity, (r.change_day - day(0)).days), (0, 0))
        got[r.entity, (r.change_day - day(0)).days] = (c + r.companies, f + r.covered)
    assert {k: v for k, v in got.items() if v != (0, 0)} == {(1, 0): (1, 1), (1, 5): (-1, -1), (2, 0): (1, 0), (2, 3): (0, 1), (2, 8): (-1, -1), (None, 1): (1, 1), (None, 6): (-1, -1), (3, 40): (1, 1), (3, 41): (0, -1), (3, 46): (-1, 0)}


def test_words_and_pairs_are_shuffled_once(spark, tmp_path):
    for name, ids in (("once", [1, 2, 3]), ("twice", [1, 2, 2])):
        spark.createDataFrame(list(zip(ids, ["a b a", "b a", "a b"], strict=True)), "doc_id long, text string").write.parquet(f"{tmp_path}/{name}/documents.parquet")
        df = defined.words_and_pairs(spark, f"{tmp_path}/{name}")
        got = {r.gram: (r.n, r.docs) for r in df.collect()}
        assert got == {"a": (4, len(set(ids))), "b": (3, len(set(ids))), "a_b": (2, 2), "b_a": (2, 2)}
        assert name == "twice" or plan(df).count("Aggregate [") == 1


def test_tasks_that_count_runs_of_words_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(textual, "TASK_BYTES", 100)
    docs = spark.createDataFrame([("x" * 50,)] * 40, "text string").coalesce(1)
    assert textual.dealt(docs).rdd.getNumPartitions() == 20 and textual.dealt(docs.limit(0)).count() == 0


def test_models_are_given_pieces_of_bounded_size(spark):
    class Sizes:
        def encode(self, texts):
            return [[float(sum(map(len, texts)))]] * len(texts)

    docs = spark.range(40).select("id", F.when(F.col("id") != 7, F.repeat(F.lit("x"), 1 << 20)).alias("text")).coalesce(1)
    got = models.embed(docs, Sizes).collect()
    assert len(got) == 40 and all((r.embedding is None) == (r.id == 7) for r in got)
    assert max(r.embedding[0] for r in got if r.embedding) <= models.BATCH_BYTES + (1 << 20)


def test_quartiles_come_from_ranges(spark, monkeypatch):
    monkeypatch.setattr(evaluate, "RANGE_ROWS", 10)
    x = [float(v) for v in np.random.default_rng(2).integers(0, 90, 301)]
    s = R.summary(spark.createDataFrame([(v, None) for v in x] + [(None, None)], "x double, y int"), ["x", "y"])
    assert "percentile(" not in plan(s)
    a, b = s.collect()
    assert np.allclose((a.q25, a.q50, a.q75, a.lowest, a.highest, a.n), (*np.quantile(x, [0.25, 0.5, 0.75]), min(x), max(x), 301))
    assert (b.name, b.n, b.mean, b.lowest, b.q50) == ("y", 0, None, None, None)


def test_tables_are_derived_once(spark):
    """What a dictionary is derived from isn't part of the plans that look it up."""
    table = spark.range(5).select(F.concat(F.lit("t"), "id").alias("term"), F.md5(F.col("id").cast("string")).alias("value"))
    lookup = D.Lookup(table)
    rows = spark.createDataFrame([(1, ["t1", "t9"])], "id long, words array<string>")
    df = D.hits(rows, "words", lookup, "id")
    assert "md5(" not in plan(df) and [(r.term, r.n) for r in df.collect()] == [("t1", 1)]


def test_sentences_and_tokens_in_one_pass(spark):
    texts = ["The KING\u212Aing. \u0130st! \u00C9tat, a-B_c9D.\n", "a.b c? \x0bd \x01e\x01\x01 f . ", "No end.\u00a0Here...  X?! y", ".! a", "a. \u2028b.\r\n\tc", " ", "", None]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    got = df.select(X.sentences(F.col("text")).alias("s"), X.tokens_and_ends(F.col("text")).alias("w")).select(F.transform("s", X.tokens).alias("s"), "w").collect()
    for r in got:
        parts = [[]]
        for w in r.w or []:
            parts[-1].append(w) if w else parts.append([])
        assert (r.w is None) == (r.s is None) and parts == (r.s or [[]])


def test_phrases_read_the_texts_once(spark):
    """Words' counts are sums of pairs', rare ones and ends of sentences included."""
    rows = [["a", "b", "a", "b", "c"], ["a", "b", "", "c", "a", None, "b"], ["b"], ["d", "", "d", ""], [], None]
    read = spark.sparkContext.accumulator(0)

    def seen(w):
        read.add(1)
        return w

    df = spark.createDataFrame(list(enumerate(rows)), "k int, w array<string>").select(F.udf(seen, "array<string>")("w").alias("words"))
    got = {(r["first"], r["second"]): (r["n"], r["n_a"], r["n_b"], r["vocabulary"], r["score"]) for r in V.bigram_phrases(df, 1, 0.0).collect()}
    assert read.value == len(rows)
    assert got == {("a", "b"): (3, 4, 5, 4, 2 * 4 / 20)}
    low = {(r["first"], r["second"]): r["score"] for r in V.bigram_phrases(df, 1, -1.0).collect()}
    assert low == {("a", "b"): 0.4, ("b", "a"): 0.0, ("b", "c"): 0.0, ("c", "a"): 0.0}


def test_runs_of_words_by_arrow(spark, monkeypatch):
    """They are those of the column functions, in pieces of any size, for rows that share a key as well."""
    texts = ["The KING\u212Aing. \u0130st! \u00C9tat, a-B_c9D.\n", "a.b c? \x0bd \x01e\x01\x01 f . ", "No end.\u00a0Here...  X?! y", None, ".! a", "a. \u2028b.\r\n\tc", " ", "", "a b a b a. a b"]
    df = spark.createDataFrame([(k % 7, t) for k, t in enumerate(texts)], "k int, text string").coalesce(1)
    words = F.transform(X.sentences(F.col("text")), X.tokens)
    each = df.select("k", F.posexplode(words).alias("sent_idx", "w")).select("k", "sent_idx", F.explode(D.grams(F.col("w"), 3)).alias("term"))
    docs = df.select(F.explode(F.array_distinct(F.flatten(F.transform(words, lambda w: D.grams(w, 3))))).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    for size in (1, 30, 8 << 20):
        monkeypatch.setattr(A, "PIECE_BYTES", size)
        got = A.sentence_grams(df, "text", "k", longest=3)
        assert got.schema.names == ["k", "sent_idx", "term"] and sorted(got.collect()) == sorted(each.collect())
        assert sorted(A.document_counts(df, "text", 3).collect()) == sorted(docs.collect())


def test_words_that_a_large_table_lacks_are_left_out_before_the_shuffle(spark, monkeypatch):
    monkeypatch.setattr(D, "MAX_BROADCAST", 0)
    monkeypatch.setattr(D, "PART_LONGS", 64)
    table = spark.range(2000).select(F.concat(F.lit("t"), "id").alias("term"), (F.col("id") % 3).cast("string").alias("value"))
    lookup = D.Lookup(table)
    each = spark.range(100_000).select((F.col("id") % 7).alias("k"), F.concat(F.lit("t"), "id").alias("term"))
    likely = lookup.likely(each)
    assert likely.join(table, "term").count() == 2000 and likely.count() < 10_000
    df = D.totals(each, lookup, "k")
    assert plan(df).count("shiftright") and sum(r.total for r in df.collect()) == 2000
    assert {(r.k, r.topic): r.n_terms for r in df.collect()} == {(k, str(v)): sum(i % 7 == k and i % 3 == v for i in range(2000)) for k in range(7) for v in range(3)}
