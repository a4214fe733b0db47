from __future__ import annotations

import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, size long, spans string, words string"


def texts():
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefgé") for _ in range(rng.randint(2, 7)))
    prose = lambda n: " ".join(word() + rng.choice(["", "", ",", ".\n", "!"]) for _ in range(n))
    base, passage = prose(200), prose(20)
    w = base.split(" ")
    near = " ".join(w[:100] + ["changed"] + w[101:])
    return [
        base, near, base, None, "", " \t\n", "one", "two words", "Aé" * 20_000, prose(30) + " " + passage + " " + prose(30), passage, prose(50) + passage, "x" * 200, "x" * 120,
        "Released under the MIT License. mit-license GENERAL public license", "Licensed under the Apache License, Version 2.0. " + prose(20), prose(4000), base.upper(), "日本語 テキスト です " * 30, prose(12), "a  b\n\n\nc\td   ",
    ]


def docs_rows():
    out = []
    for i, t in enumerate(texts()):
        source = [None, "b", "a", "é"][i % 4]
        out.append((i * 3, t, "en", source, len(t or ""), 0.5, 7, "clash", "clash"))
    out.append(out[0])  # a repeated row
    return out


@pytest.fixture(scope="session")
def small(spark, tmp_path_factory):
    """Tables with nulls, empty and long texts, copies, a repeated row and columns of clashing names."""
    d = tmp_path_factory.mktemp("small")
    spark.createDataFrame(docs_rows(), SCHEMA).repartition(3).write.parquet(f"{d}/documents.parquet")
    # Texts of ten words or more are good: the figures of a text tell.
    labels = [(i * 3, int(len((t or "").split()) >= 10), None) for i, t in enumerate(texts())]
    spark.createDataFrame(labels[:20], "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    return str(d)


@pytest.fixture(scope="session")
def empty(spark, tmp_path_factory):
    d = tmp_path_factory.mktemp("empty")
    spark.createDataFrame([], SCHEMA).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    return str(d)


@pytest.fixture(scope="session")
def nulls(spark, tmp_path_factory):
    """Rows in which any column, the id included, is null."""
    d = tmp_path_factory.mktemp("nulls")
    rows = [(None, "some text of five words here", "en", "a", 3, None, None, None, None), (None, None, None, None, None, None, None, None, None), (5, "some text of five words here", None, None, None, None, None, None, None), (7, "z", "en", "a", 1, 0.1, 1, "", "")]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(None, 1, 0), (5, None, None)], "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    return str(d)
