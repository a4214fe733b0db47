"""The corpus queries against brute force, over the small table and the smallest of the given ones."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest

pytest.importorskip("loomtext.llm.registry")
import public_tokenizers  # noqa: E402
from tokenizers import Tokenizer  # noqa: E402

from loomtext.llm import registry  # noqa: E402

SF = "/root/testdata/sf0.001"
Q = registry.queries()
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def docs_of(spark, d):
    return sorted(((r.doc_id, r.text or "", r.source) for r in spark.read.parquet(f"{d}/documents.parquet").collect()), key=lambda r: (r[0], r[1]))


def rows_of(spark, name, d):
    return sorted(Q[name](spark, d).collect(), key=repr)


@pytest.fixture(params=["small", "sf"])
def data(request):
    return request.getfixturevalue("small") if request.param == "small" else SF


#: One row per document; the others' cases are in test_repair_audit.py.
BY_DOCUMENT = sorted(set(Q) - {"op11_conversation_repair", "op13_filter_audit"})


@pytest.mark.parametrize("name", BY_DOCUMENT)
def test_empty_and_null_tables(spark, empty, nulls, name):
    assert Q[name](spark, empty).collect() == []
    got = Q[name](spark, nulls).collect()
    assert len(got) == 4 and sum(r["doc_id"] is None for r in got) == 2


def test_sharding(spark, data):
    docs, out = docs_of(spark, data), rows_of(spark, "op1_sharding", data)
    assert sorted((r.doc_id, r.size, r.text_crc32) for r in out) == sorted((i, len(t.encode()) + 16, zlib.crc32(t.encode())) for i, t, _ in docs)
    slots = defaultdict(list)
    for r in out:
        slots[r.shard].append(r.slot)
    counts = [len(slots.get(s, [])) for s in range(40)]
    assert max(counts) - min(counts) <= 1 and all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert out == rows_of(spark, "op1_sharding", data)


def test_hypergeometric_draws(spark):
    """The matrix' draws have the law's mean and variance, and exact margins."""
    from pyspark.sql import functions as F

    from loomtext.llm.sharding import _draw

    x = spark.range(4000).select(F.expr(_draw("1000L", "300L", "200L", "shiftrightunsigned(xxhash64(7, id), 11) / 9007199254740992D")).alias("x")).toPandas().x
    assert abs(x.mean() - 60) < 0.4 and abs(x.var() / (60 * 0.7 * 800 / 999) - 1) < 0.1
    edges = spark.range(1).select(*[F.expr(_draw(*a, "0.5D")).alias(f"c{i}") for i, a in enumerate([("10L", "10L", "4L"), ("10L", "0L", "4L"), ("10L", "3L", "10L"), ("10L", "3L", "0L"), ("10L", "9L", "9L")])]).first()
    assert tuple(edges)[:4] == (4, 0, 3, 0) and 8 <= edges[4] <= 9


def test_quality(spark, data):
    out = rows_of(spark, "op2_quality", data)
    assert len(out) == len(docs_of(spark, data))
    for r in out:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7)


def test_quality_accuracy(spark):
    d = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{d}/labels.parquet").collect()}
    held = [(r.predicted, labels[r.doc_id]) for r in rows_of(spark, "op2_quality", d) if r.held_out and r.doc_id in labels]
    assert np.mean([p == q for p, q in held]) >= 0.88


def test_token_files(spark, data):
    tok, start = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")), 0
    out = sorted(rows_of(spark, "op3_token_files", data), key=lambda r: (r.doc_id, r.start))
    for (i, t, _), r in zip(docs_of(spark, data), out, strict=True):
        ids = np.array(tok.encode(t, add_special_tokens=False).ids + [1], "<u4")
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (i, start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_packing(spark, data):
    tok, want = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), []
    for i, t, _ in docs_of(spark, data):
        ids = np.array(tok.encode(t, add_special_tokens=False).ids + [0], "<u4")
        at, stop, piece = 0, len(ids) % 2048 or min(len(ids), 2048), 0
        while at < len(ids):
            want.append((i, piece, at, stop - at, zlib.crc32(ids[at:stop].tobytes())))
            at, stop, piece = stop, stop + 2048, piece + 1
    out = rows_of(spark, "op4_packing", data)
    assert sorted(tuple(r)[:5] for r in out) == sorted(want)
    full = defaultdict(list)
    for r in out:
        full[r.sequence_id].append((r.offset, r.length))
    for pieces in full.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(full) <= -(-sum(w[3] for w in want) // 2048) * 1.02 + 1


def shingles(t):
    w = t.lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def likeness(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def test_fingerprints(spark, data):
    docs = docs_of(spark, data)
    out = sorted(rows_of(spark, "op5_fingerprints", data), key=lambda r: (r.doc_id, r.n_chars))
    by_text, off = {}, []
    for k, ((i, t, _), r) in enumerate(zip(docs, out, strict=True)):
        nxt = docs[(k + 1) % len(docs)][1]
        q = len(t) // 4
        edited = t[: len(t) - q] + nxt[:q]
        assert (r.doc_id, r.n_chars, r.edited_sha256) == (i, len(t), hashlib.sha256(edited.encode()).hexdigest())
        assert by_text.setdefault(t, r.fingerprint) == r.fingerprint
        off.append((r.near_edited - likeness(shingles(t), shingles(edited)), r.near_next - likeness(shingles(t), shingles(nxt))))
    assert np.abs(np.array(off)).max() < 0.25 and np.abs(np.mean(off, axis=0)).max() < 0.05


def test_repeats(spark, data):
    docs, first = docs_of(spark, data), {}
    for i, t, _ in docs:
        raw = t.encode()
        for p in range(len(raw) - 49):
            first[raw[p : p + 50]] = min(first.get(raw[p : p + 50], i), i)
    want = []
    for i, t, _ in docs:
        raw = t.encode()
        gone = np.zeros(len(raw) + 1, bool)
        for p in range(len(raw) - 49):
            if first[raw[p : p + 50]] < i:
                gone[p : p + 50] = True
        kept = bytes(np.frombuffer(raw, np.uint8)[~gone[:-1]])
        want.append((i, len(raw), int(gone.sum()), int((gone[:-1] & ~np.r_[False, gone[:-2]]).sum()) if raw else 0, hashlib.sha256(kept).hexdigest()))
    assert sorted(tuple(r) for r in rows_of(spark, "op6_prefix_free_parsing", data)) == sorted(want)


PHRASES = {"mit": "mit license", "apache": "apache license", "gpl": "general public license"}


def test_licenses(spark, data):
    word, want = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+"), []
    for i, t, _ in docs_of(spark, data):
        w = word.findall(t.translate(UPPER))
        at = [(k, n) for n, p in PHRASES.items() for k in range(len(w)) if w[k : k + len(p.split())] == p.split()]
        want.append((i, len(w), len(at), min(at)[0] if at else None, max(at)[0] if at else None, ",".join(sorted({n for _, n in at}))))
    out = rows_of(spark, "op7_licenses", data)
    assert sorted((tuple(r)[:6] for r in out), key=repr) == sorted(want, key=repr)
    for r in out:
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1
    found = {r.labels for r in out}
    assert any("apache-2.0" in x for x in found)


def test_media(spark, data):
    from loomtext.llm import media

    want = []
    for i, t, _ in docs_of(spark, data):
        raw = t.encode()
        pay = raw + bytes(max(64, -(-len(raw) // 64) * 64) - len(raw))
        m = media.encode(pay)
        want.append((i, len(raw), len(pay), hashlib.sha256(pay).hexdigest(), zlib.crc32(pay[-64:]), len(m), hashlib.sha256(m).hexdigest()))
    out = rows_of(spark, "op8_media", data)
    assert sorted(tuple(r)[:7] for r in out) == sorted(want)
    assert all(re.search(r"crc=(\d+)/\1;", r.feature) and "skipped=0" in r.feature for r in out)


def components_of(docs, percent):
    sets, nodes, inverse, parent = {}, [], defaultdict(list), {}
    for i, t, _ in docs:
        w = t.translate(UPPER).encode().split()
        s = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
        sets[i] = s
        nodes.append(i)

    def find(x):
        while parent.get(x, x) != x:
            x = parent[x]
        return x

    for i in sets:
        common = defaultdict(int)
        for g in sets[i]:
            for j in inverse[g]:
                common[j] += 1
            inverse[g].append(i)
        for j, n in common.items():
            if 100 * n >= percent * (len(sets[i]) + len(sets[j]) - n):
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    return [(i, len(sets[i]), find(i), find(i) == i) for i in nodes]


def test_near_duplicates(spark, data):
    assert sorted(tuple(r) for r in rows_of(spark, "op9_superminhash", data)) == sorted(components_of(docs_of(spark, data), 85))


def test_mixing(spark, data):
    docs = docs_of(spark, data)
    size = [len(re.findall(r"[^\x20\x09-\x0D]+", t)) for _, t, _ in docs]
    total = defaultdict(int)
    for (_, _, s), n in zip(docs, size, strict=True):
        total[s] += n
    order = sorted(total, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    target, free, left = {}, set(order), float(sum(size))
    while True:
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if share[s] > 3 * total[s]]
        if not over:
            break
        for s in over:
            target[s] = 3.0 * total[s]
            left -= target[s]
            free.discard(s)
    target |= share
    out = rows_of(spark, "op10_mixing", data)
    assert sorted((r.doc_id, r.size) for r in out) == sorted((i, n) for (i, _, _), n in zip(docs, size, strict=True))
    source, taken = {i: s for i, _, s in docs}, defaultdict(int)
    for r in out:
        s = source[r.doc_id]
        assert r.source_size == total[s] and abs(r.target - target[s]) < 1e-6 * max(1, target[s]) and 0 <= r.taken <= 3 * r.size
        taken[s] += r.taken
    assert all(abs(taken[s] - target[s]) <= 1.001 for s in target)
    assert out == rows_of(spark, "op10_mixing", data)
