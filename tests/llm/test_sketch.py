"""Fingerprints against the definition of one-permutation MinHash with optimal densification, bin by bin."""

from __future__ import annotations

import random
import re

import xxhash
from pyspark.sql import functions as F

from loomtext.llm import fingerprints as fp

from .test_queries import SF, docs_of


def signed(h):
    return h - (1 << 64) if h >> 63 else h


def hashed(*parts):
    """Spark's xxhash64: each value is hashed with the hash of those before it as its seed."""
    h = 42
    for p in parts:
        h = xxhash.xxh64_intdigest(p, seed=h)
    return h


def as_bytes(n, size):
    return n.to_bytes(size, "little", signed=n < 0)


def by_definition(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text.lower()) if w]
    if not words:
        return ""
    if len(words) < fp.SHINGLE:
        shingles = {hashed(" ".join(words).encode())}
    else:
        h = [as_bytes(hashed(w.encode()), 8) for w in words]
        shingles = {hashed(*h[i : i + fp.SHINGLE]) for i in range(len(h) - fp.SHINGLE + 1)}
    least = {}
    for s in map(signed, shingles):
        b = (s >> (64 - fp.BIN_BITS)) + fp.BINS // 2
        least[b] = min(least.get(b, s), s)
    rng, values = random.Random(5), []
    for b in range(fp.BINS):
        order = list(range(fp.BINS))
        rng.shuffle(order)
        values.append(least[b] if b in least else signed(hashed(as_bytes(b, 4), as_bytes(least[next(p for p in order if p in least)], 8))))
    # Sixteen bins to a number, the first in its highest bits: one hexadecimal digit for each bin.
    return "".join(f"{v & 15:X}" for v in values)


def test_sketch_by_definition(spark):
    texts = ["", " \t\n", "one", "A b c d", "a b c d e", "a b c d e f", "same " * 40, *[t for _, t, _ in docs_of(spark, SF) if t.isascii()][:60]]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.f for r in df.select("doc_id", fp.fingerprint_text(fp.packed(F.col("text"))).alias("f")).collect()}
    assert got == {i: by_definition(t) for i, t in enumerate(texts)}
