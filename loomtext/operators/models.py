"""Model scoring: a plug-in takes a pandas frame of (text, label) pairs and returns scores; a stub stands in for it."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bytes of rows that an embedding model is given at once.
BATCH_BYTES = 4 << 20


class StubScorer:
    """A deterministic score in [0, 1) from a hash of the pair."""

    def score(self, texts, labels) -> list[float]:
        return [int(hashlib.md5(f"{t}|{x}".encode()).hexdigest()[:7], 16) / 16**7 for t, x in zip(texts, labels, strict=True)]


def score_pairs(df: DataFrame, loader: Callable[[], object] = StubScorer, text: str = "text", label: str = "label") -> DataFrame:
    """``df`` with ``score``; each worker loads its model once, batches are Arrow batches. Failures are raised."""
    schema = df.withColumn("score", F.lit(0.0)).schema

    def run(frames: Iterator) -> Iterator:
        model = loader()
        for pdf in frames:
            yield pdf.assign(score=model.score(pdf[text], pdf[label]))

    return df.mapInPandas(run, schema)


def score_lists(df: DataFrame, key: str, lists: str, label: str, loader: Callable[[], object] = StubScorer) -> DataFrame:
    """(key, scores): a score for each text of a row's list, in its order; an empty list where there are no texts.

    The texts are laid flat, so that batches are of one size whatever the lists' lengths.
    """
    flat = df.select(key, F.posexplode(lists).alias("at", "text")).withColumn("label", F.lit(label))
    placed = F.array_sort(F.collect_list(F.struct("at", "score")))
    scored = score_pairs(flat, loader).groupBy(key).agg(F.transform(placed, lambda s: s["score"]).alias("scores"))
    return df.select(key).join(scored, key, "left").withColumn("scores", F.coalesce("scores", F.array().cast("array<double>")))


class StubEmbedder:
    """Two numbers for a text: its characters and its vowels."""

    def encode(self, texts) -> list[list[float]]:
        return [[float(len(t)), float(sum(t.count(v) for v in "aeiou"))] for t in texts]


def embed(df: DataFrame, loader: Callable[[], object], text: str = "text") -> DataFrame:
    """``df`` with ``embedding``; each worker loads its model once. A null text has a null embedding, failures are raised.

    Arrow batches are taken in pieces of some BATCH_BYTES, so that a worker's memory doesn't grow with rows or texts.
    """
    schema = df.withColumn("embedding", F.lit(None).cast("array<double>")).schema

    def run(frames: Iterator) -> Iterator:
        model = loader()
        for batch in frames:
            rows = max(1, batch.num_rows * BATCH_BYTES // max(batch.nbytes, 1))
            for at in range(0, batch.num_rows, rows):
                piece = batch.slice(at, rows)
                texts = piece.column(text).to_pandas()
                some = texts.notna()
                vectors = iter(model.encode(texts[some]) if some.any() else [])
                found = pa.array([next(vectors) if x else None for x in some], pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([*piece.columns, found], names=[*piece.schema.names, "embedding"])

    return df.mapInArrow(run, schema)


def udf_of(fn: Callable, kind: str):
    """A row-wise UDF by type keyword, for logic that has no column form; an unknown keyword is a ValueError."""
    from ..sources.io import TYPE_KEYWORDS

    if kind not in TYPE_KEYWORDS:
        raise ValueError(f"unknown type: {kind}")
    return F.udf(fn, TYPE_KEYWORDS[kind])


def score_or_error(df: DataFrame, loader: Callable[[], object] = StubScorer, text: str = "text", label: str = "label") -> DataFrame:
    """``df`` with ``score`` and ``error``: a batch that fails is halved until the failing rows stand alone.

    Such a row has a null score and the failure's text; all others have their score and a null error. What fails to load
    is raised. A batch with m failing rows costs at most 2 m log2(batch) calls more.
    """
    schema = df.withColumn("score", F.lit(None).cast("double")).withColumn("error", F.lit(None).cast("string")).schema

    def attempt(model, texts, labels) -> list[tuple]:
        try:
            return [(s, None) for s in model.score(texts, labels)]
        except Exception as e:
            if len(texts) == 1:
                return [(None, f"{type(e).__name__}: {e}")]
            half = len(texts) // 2
            return attempt(model, texts[:half], labels[:half]) + attempt(model, texts[half:], labels[half:])

    def run(frames: Iterator) -> Iterator:
        model = loader()
        for pdf in frames:
            found = attempt(model, pdf[text].tolist(), pdf[label].tolist()) if len(pdf) else []
            yield pdf.assign(score=[s for s, _ in found], error=[e for _, e in found])

    return df.mapInPandas(run, schema)


def score_lists_or_empty(df: DataFrame, key: str, lists: str, label: str, loader: Callable[[], object] = StubScorer) -> DataFrame:
    """(key, scores, error) as :func:`score_lists`; a list with a failing text is empty and has that failure's text."""
    flat = df.select(key, F.posexplode(lists).alias("at", "text")).withColumn("label", F.lit(label))
    placed = F.array_sort(F.collect_list(F.struct("at", "score")))
    scored = score_or_error(flat, loader).groupBy(key).agg(F.transform(placed, lambda s: s["score"]).alias("scores"), F.min_by("error", F.when(F.col("error").isNotNull(), F.col("at"))).alias("error"))
    none = F.array().cast("array<double>")
    return df.select(key).join(scored, key, "left").select(key, F.when(F.col("error").isNull(), F.coalesce("scores", none)).otherwise(none).alias("scores"), "error")
