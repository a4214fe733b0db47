"""Repeated strings against brute force, with groups cut over batches, hot triggers, runs and rulers."""

from __future__ import annotations

import random

import numpy as np
import pytest

from loomtext.llm import repeats


def crafted():
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdé") for _ in range(rng.randint(1, 5)))
    prose = lambda n: " ".join(word() for _ in range(n))
    shared = [prose(12) for _ in range(6)]
    rows = []
    for i in range(120):
        kind = i % 6
        if kind == 0:
            text = prose(rng.randint(0, 40))
        elif kind == 1:  # one passage with other words around it: many phrases of one trigger
            text = word() + shared[0][: rng.randint(20, len(shared[0]))] + word() + " " + prose(3) + shared[0][rng.randint(0, 9) :]
        elif kind == 2:
            text = " ".join(rng.choice(shared) for _ in range(3))
        elif kind == 3:
            text = prose(4) + rng.choice(["=", "-=", "ab c", "\0"]) * rng.randint(10, 90) + prose(4)
        elif kind == 4:  # passages cut at every place
            base = shared[1] + shared[2]
            a = rng.randint(0, 30)
            text = base[a : a + rng.randint(48, 90)]
        else:
            text = rng.choice(rows)[1] if rows else ""
        rows.append((rng.choice([i, i, i // 2, None]), text))
    return rows


def brute(rows):
    least: dict[bytes, int] = {}
    key = lambda i: -(2**63) if i is None else i
    for i, t in rows:
        raw = t.encode()
        for p in range(len(raw) - 49):
            w = raw[p : p + 50]
            least[w] = min(least.get(w, key(i)), key(i))
    out = []
    for i, t in rows:
        raw = t.encode()
        gone = np.zeros(len(raw), bool)
        for p in range(len(raw) - 49):
            if least[raw[p : p + 50]] < key(i):
                gone[p : p + 50] = True
        out.append((i, t, int(gone.sum())))
    return sorted(out, key=repr)


@pytest.mark.parametrize("hot, parts, batch", [(4096, 1, 10_000), (2, 24, 7)])
def test_marks_are_those_of_brute_force(spark, monkeypatch, hot, parts, batch):
    rows = crafted()
    monkeypatch.setattr(repeats, "HOT_PHRASES", hot)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        df = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
        got = [(r.doc_id, r.text, sum(b - a for a, b in repeats.removed_spans(r[repeats.SPANS]))) for r in repeats.with_marks(df).collect()]
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert sorted(got, key=repr) == brute(rows)


def test_a_run_of_a_byte_is_few_rows(spark):
    df = spark.createDataFrame([(1, 1, "x" * 200_000)], "doc long, text_hash long, text string")
    assert repeats.parse(df).count() < 10


def test_known_phrases_stay_bounded():
    known = repeats.Known()
    for k in range(0, 5 * repeats.KNOWN_PHRASES, repeats.KNOWN_PHRASES // 2):
        known.add(np.arange(k, k + repeats.KNOWN_PHRASES // 2).astype(np.uint64), np.full(repeats.KNOWN_PHRASES // 2, 3))
        assert len(known.phrase) <= repeats.KNOWN_PHRASES
        assert known.before(np.array([k], np.uint64), np.array([4])).all() and not known.before(np.array([k], np.uint64), np.array([3])).any()
