"""Rows that share an id but not a text."""

from __future__ import annotations

import pytest

pipeline = pytest.importorskip("corpus_pipeline")

from .test_queries import Q  # noqa: E402


def prose(name, n=120):
    return " ".join(f"{name}{i}" for i in range(n))


def near(text):
    return text + " more words"


ROWS = [
    (1, prose("a")), (1, prose("b")), (1, prose("b")),  # two texts, one of them twice
    (2, near(prose("a"))), (3, near(prose("b"))),  # a copy of each
    (4, prose("c")), (4, near(prose("c"))),  # two texts that are alike
    (5, near(prose("c"))), (5, prose("d")), (6, near(prose("d"))),  # one text is another id's copy, one has a copy
    (7, None), (7, ""), (7, prose("e")), (8, ""), (None, prose("a")),
]
#: Component of each row above.
WANT = [1, 1, 1, 1, 1, 4, 4, 4, 5, 5, 7, 7, 7, 8, None]


def test_each_text_of_an_id_is_judged(spark, tmp_path):
    spark.createDataFrame([(*r, "en") for r in ROWS], "doc_id long, text string, lang string").repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in Q["op9_superminhash"](spark, str(tmp_path)).collect()), key=repr)
    size = lambda t: max(0, len((t or "").split()) - 4)
    assert got == sorted(((i, size(t), c) for (i, t), c in zip(ROWS, WANT, strict=True)), key=repr)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    out = pipeline.near_duplicate(spark, docs, str(tmp_path))
    assert out.columns == docs.columns
    kept = sorted(((r.doc_id, r.text) for r in out.collect()), key=repr)
    of_4 = [t for i, t in kept if i == 4]
    assert len(of_4) == 1 and of_4[0] in (prose("c"), near(prose("c")))
    assert kept == sorted([(1, prose("a")), (1, prose("b")), (4, of_4[0]), (5, prose("d")), (7, None), (7, ""), (7, prose("e")), (8, ""), (None, prose("a"))], key=repr)
