"""Parts of the corpus operators on their own."""

from __future__ import annotations

import random

import numpy as np
import pytest

pytest.importorskip("loomtext.llm.registry")
import public_tokenizers  # noqa: E402
from hypothesis import given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402

from loomtext.llm import media, packing, superminhash, tokenfiles  # noqa: E402
from loomtext.llm.encoding import encoder  # noqa: E402
from loomtext.llm.graph import components  # noqa: E402

FILES = ["word_bpe_49k.json", "byte_bpe_50k.json"]
ODD = ["", " ", "\n", "a  b", "a\n\nb", "a\n\n", "\n\na", "a\n\n\nb", "a \nb", "a\n b", " a", "a ", "don't  stop'll", "A<|endoftext|>b", "tab\tx", "日本語 テキスト。", "é ΣΑΣ İx", "a\r\nb", "x\xa0y", "ﬁ ① ½ x²", "a\x1fb", "a\x85b", "🙂 ok", "schöte, ÜBER ß", "é a"]


@pytest.mark.parametrize("name", FILES)
def test_encoder_is_exact(name):
    e = encoder(public_tokenizers.path(name))
    for t in ODD:
        assert e.encode([t])[0] == e.whole(t), t


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("abÉé' ,.\n\t!1_<|")), max_size=40), st.sampled_from(FILES))
def test_encoder_is_exact_on_any_text(text, name):
    e = encoder(public_tokenizers.path(name))
    assert e.encode([text])[0] == e.whole(text)


@settings(max_examples=60, deadline=None)
@given(st.binary(max_size=5000))
def test_media_round_trip(data):
    p = media.pad(data)
    d = media.decode(media.encode(p))
    assert d["payload"] == p and d["crc_ok"] == d["crc_seen"] == len(d["offsets"]) == d["vbr"]["frames"] and not d["skipped"]


def test_media_resynchronises():
    p = bytes(range(256)) * 40
    m = media.encode(p)
    d = media.decode(m)
    cut = d["offsets"][2]
    broken = m[:cut] + b"\xff\xfbnoise" + m[cut:]
    e = media.decode(broken)
    assert e["payload"] == p and e["skipped"] == 7 and e["offsets"][2] == cut + 7
    flipped = bytearray(m)
    flipped[d["offsets"][1] + 10] ^= 1
    assert media.decode(bytes(flipped))["crc_ok"] == d["crc_seen"] - 1
    assert media.seek(m, 1152 * 3) == d["offsets"][3]


@settings(max_examples=40, deadline=None)
@given(st.dictionaries(st.integers(1, 2048), st.integers(1, 30), max_size=60))
def test_plan_places_every_piece_once(histogram):
    placed: dict[int, list[int]] = {}
    for count, slots in packing.plan_packing(histogram):
        assert sum(length for length, _ in slots) <= 2048 and count > 0
        for length, first in slots:
            placed.setdefault(length, []).extend(range(first, first + count))
    assert {k: sorted(v) for k, v in placed.items()} == {k: list(range(v)) for k, v in histogram.items()}


def test_superminhash_matches_its_definition():
    """Against the algorithm element by element; and its estimate is unbiased."""
    rng = random.Random(1)
    a = np.unique(np.array([rng.getrandbits(64) for _ in range(90)], np.uint64))
    b = np.unique(np.r_[a[:60], np.array([rng.getrandbits(64) for _ in range(30)], np.uint64)])
    sig = superminhash.signatures([a, b, a[:1]])
    low = [np.iinfo(np.int64).max] * superminhash.PLACES
    mask = (1 << 64) - 1
    for x in a.tolist():
        perm = list(range(superminhash.PLACES))
        for j in range(superminhash.PLACES):
            r = int(superminhash.mixed(np.array([(x + (j + 1) * int(superminhash._GOLD)) & mask], np.uint64))[0])
            k = j + ((r >> 32) * (superminhash.PLACES - j) >> 32)
            perm[j], perm[k] = perm[k], perm[j]
            low[perm[j]] = min(low[perm[j]], j << 32 | r & 0xFFFFFFFF)
    assert sig[0].tolist() == low
    assert abs((sig[0] == sig[1]).mean() - 0.5) < 0.15


def test_components(spark):
    rng = random.Random(2)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(1000 + i, 1001 + i) for i in range(150)]
    parent = {}

    def find(x):
        while parent.get(x, x) != x:
            x = parent[x]
        return x

    for x, y in links:
        p, q = sorted((find(x), find(y)))
        if p != q:
            parent[q] = p
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long").repartition(5)).collect()}
    assert got == {x: find(x) for pair in links for x in pair if pair[0] != pair[1]}


def test_token_file_reads_one_document():
    zstandard = pytest.importorskip("zstandard")
    samples = [np.arange(i, i + 50, dtype="<u2").tobytes() for i in range(200)]
    d = tokenfiles.train_dictionary(samples, 2048)
    press = zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(d))
    frames = [press.compress(s) for s in samples]
    f = tokenfiles.TokenFile.of_bytes(tokenfiles.join_file(d, 2, {}, [None, *range(1, 200)], [50] * 200, frames), d)
    assert f.keys[0] is None and f.ids(7).tolist() == list(range(7, 57))
    with pytest.raises(ValueError):
        tokenfiles.TokenFile.of_bytes(tokenfiles.join_file(d, 2, {}, [1], [50], frames[:1]), d + b"x")


def test_links_in_blocks(spark, monkeypatch):
    """Members of a mixed bucket, over several blocks: no link between different roots is lost."""
    from pyspark.sql import functions as F

    monkeypatch.setattr(superminhash, "BLOCK_MEMBERS", 4)
    rng = random.Random(3)
    base = [f"w{i}" for i in range(60)]
    texts = {}
    for i in range(20):
        w = list(base)
        for _ in range(i % 4):
            w[rng.randrange(60)] = f"x{i}{rng.random()}"
        texts[i] = " ".join(w if i % 5 else [f"y{k}" for k in range(60)])
    sets = {i: set(superminhash.shingle_sets([t], superminhash.WordHashes())[0].tolist()) for i, t in texts.items()}
    linked = {(a, b) for a in texts for b in texts if a < b and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])}
    members = spark.createDataFrame([(1, i, 20, i) for i in texts], "bucket long, node long, m long, root long")
    bodies = spark.createDataFrame(list(texts.items()), "node long, body string")
    got = {tuple(r) for r in superminhash.links_in_blocks(members, bodies, 85).select(F.col("a"), F.col("b")).collect()}
    assert got == linked


def test_one_document_is_read_by_its_offset(tmp_path):
    ids = [np.arange(k, 3 * k + 1, dtype="<u2") for k in range(500)]
    import zstandard

    press = zstandard.ZstdCompressor()
    data = tokenfiles.join_file(b"", 2, {}, list(range(500)), [len(i) for i in ids], [press.compress(i.tobytes()) for i in ids])
    tokenfiles.put(f"{tmp_path}/a.ltok", data)
    f, seen = tokenfiles.TokenFile.stored(f"{tmp_path}/a.ltok", b""), []
    read = f.read
    f.read = lambda at, n: seen.append(n) or read(at, n)
    assert f.ids(437).tolist() == ids[437].tolist()
    assert sum(seen) < len(data) // 20


@pytest.mark.parametrize("value", [b"x1", b"", b"-5", b"9" * 40, "\u00b2".encode()])
def test_a_damaged_length_tag_is_left_out(value):
    m = media.encode(media.pad(b"some text" * 30))
    at = m.index(b"payload_bytes\0") + 14
    n = len(str(len(media.pad(b"some text" * 30))))
    broken = m[:at] + value[:n].ljust(n, b"?") + m[at + n :]
    assert media.decode(broken)["payload"].startswith(b"some text" * 30)


def test_any_cut_or_noise_is_decoded():
    rng = np.random.default_rng(1)
    m = media.encode(media.pad(bytes(rng.integers(0, 256, 3000, dtype=np.uint8))))
    for k in range(300):
        cut = bytearray(m[rng.integers(0, 200) : len(m) - rng.integers(0, 200)])
        for at in rng.integers(0, len(cut), 40):
            cut[at] = rng.integers(0, 256)
        media.decode(bytes(cut))
    assert media.decode(b"")["rate"] is None and media.decode(m)["rate"] == media.RATE


def test_pairs_of_one_leader_are_dealt_out(spark, monkeypatch):
    """Links don't hang on how many pairs of a node are confirmed together; a node without a text has none."""
    rng = random.Random(3)
    base = [f"w{i}" for i in range(60)]
    texts = {0: " ".join(base), 99: None}
    for i in range(1, 30):
        words = base[:]
        for _ in range(i % 4):
            words[rng.randrange(60)] = "x"
        texts[i] = " ".join(words)
    pairs = spark.createDataFrame([(0, i) for i in range(1, 30)] + [(1, 2), (4, 8), (0, 50)], "a long, b long")
    bodies = spark.createDataFrame(list(texts.items()), "node long, body string")
    sets = {i: set(superminhash.shingle_sets([t], superminhash.WordHashes())[0].tolist()) for i, t in texts.items()}
    want = {(a, b) for a, b in [tuple(r) for r in pairs.collect()] if b in sets and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])}
    assert 3 < len(want) < 29
    for most in (1, 4, 1000):
        monkeypatch.setattr(superminhash, "DEAL_PAIRS", most)
        got = [tuple(r) for r in superminhash.confirm(pairs, bodies, 85).collect()]
        assert sorted(got) == sorted(want)
