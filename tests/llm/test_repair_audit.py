"""Conversation repair, toxicity and the filter audit against brute force, and their defined cases."""

from __future__ import annotations

import hashlib
import heapq
import random
import re
import zlib
from itertools import permutations

import numpy as np
import pytest

pytest.importorskip("loomtext.llm.registry")

from loomtext.llm import conversations as C  # noqa: E402
from loomtext.llm import filteraudit as A  # noqa: E402
from loomtext.llm import toxicity as T  # noqa: E402

SF = "/root/testdata/sf0.001"
ROLES = ["user", "assistant", "system", "tool", "", "usher", None]


def cheapest(symbols):
    """Least (cost, audit) by best-first search over (row, roles so far as a state)."""
    after = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("a", "u"): "u", ("u", "a"): "a"}
    heap, done = [(0, "", 0, "")], set()
    while heap:
        cost, audit, k, state = heapq.heappop(heap)
        if (k, state) in done:
            continue
        done.add((k, state))
        if k == len(symbols) and state in ("", "a"):
            return cost, audit
        for r in "ua":
            if (state, r) in after:
                heapq.heappush(heap, (cost + 3, audit + "I", k, after[state, r]))
        if k == len(symbols):
            continue
        initial, gone, late = symbols[k]
        heapq.heappush(heap, (cost + 4, audit + "D", k + 1, state))
        if not gone:
            for r in "sua":
                if (state, r) in after and (r == initial or r != "s"):
                    heapq.heappush(heap, (cost + 3 * late + (0 if r == initial else 3), audit + ("K" if r == initial else "R"), k + 1, after[state, r]))


def test_parses_are_cheapest():
    rng = random.Random(1)
    for _ in range(400):
        symbols = [(rng.choice(["s", "u", "a", "t", ""]), rng.random() < 0.2, rng.random() < 0.2) for _ in range(rng.randint(0, 8))]
        ends = C.parse(symbols)
        assert min(ends[x] for x in "EZ" if x in ends) == cheapest(symbols)


def conversation_rows():
    rng = random.Random(3)
    rows = [(c, t, rng.choice(ROLES), rng.choice(["Fine.", "Is it?", "cut", "", " \t", None, "x. \n", "same."])) for c in range(40) for t in range(rng.randint(1, 9))]
    return rows + [rows[0], rows[0], (None, None, "user", "Hello."), (None, 3, None, None), (41, None, "user", "Hi."), (41, -7, "assistant", "Hi."), (42, 5, "user", "w" * 300_000)]


def brute(rows):
    by_conv = {}
    for c, t, r, x in rows:
        out = by_conv.setdefault(c, [])
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        r, x = " " if r is None else r, " " if x is None else x
        x = "" if kind == 1 else re.sub("[.!?]", "", x) if kind == 2 else x
        r = "user" if kind == 4 else r
        digest = hashlib.sha256(f"{len(r)}:{r}{x}".encode()).hexdigest()
        out += [((t is not None, t or 0), r, digest, x)] * {0: 0, 3: 2}.get(kind, 1)
    want = []
    for c, found in by_conv.items():
        found.sort()
        seen, symbols, n = set(), [], {"blank": 0, "duplicate": 0, "truncated": 0}
        for _, r, _, x in found:
            bare = x.strip(" \t\n\x0b\x0c\r")
            fault = "blank" if not bare else "duplicate" if (r, x) in seen else "truncated" if bare[-1] not in ".!?" else None
            seen.add((r, x))
            if fault:
                n[fault] += 1
            symbols.append((r[:1], fault in ("blank", "duplicate"), fault == "truncated"))
        turns = [k[1] for k, *_ in found if k[0]]
        cost, audit = cheapest(symbols)
        lines, rest, state = [], iter(found), ""
        for e in audit:
            r, x = (None, "") if e == "I" else next(rest)[1::2]
            if e == "D":
                continue
            r = r if e == "K" else "assistant" if state == "u" else "user"
            state = r[0]
            lines.append(f"{r}:{x}")
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(symbols, symbols[1:]))
        want.append((c, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *n.values(), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return want


def conversations_in(spark, rows, at):
    spark.createDataFrame([(*r, "clash", 1) for r in rows], "conv_id long, turn long, role string, text string, block string, copies int").repartition(3).write.parquet(f"{at}/conversations.parquet")
    return str(at)


@pytest.mark.parametrize("turns", [2, 512])
def test_repair(spark, tmp_path, monkeypatch, turns):
    """Blocks of two turns give what whole conversations do."""
    monkeypatch.setattr(C, "BLOCK_TURNS", turns)
    d = conversations_in(spark, conversation_rows(), tmp_path)
    assert sorted(map(tuple, C.op11_conversation_repair(spark, d).collect()), key=repr) == sorted(brute(conversation_rows()), key=repr)


def test_repair_of_given_and_empty_tables(spark, tmp_path):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").collect()]
    assert sorted(map(tuple, C.op11_conversation_repair(spark, SF).collect())) == sorted(brute(rows))
    assert C.op11_conversation_repair(spark, conversations_in(spark, [], tmp_path)).collect() == []


def audited(docs, labels):
    words = re.compile("[^\x20\x09-\x0d]+")
    least, parts, rows = {}, {}, []
    for i, t, _ in docs:
        if i is not None:
            least[t or ""] = min(least.get(t or "", i), i)
    for i, t, s in docs:
        t = t or ""
        w = words.findall(t)
        fails = "".join(f for f, bad in zip("ABCDE", [len(w) < 200, 100 * len(set(w)) < 50 * len(w), 100 * len(re.findall("[A-Z]", t)) > 2 * len(t), bool(re.search("[#$%&*|]", t)), i is not None and least[t] < i]) if bad)
        parts.setdefault(s or "", []).append((fails, *labels.get(i, (False, False))))
    for part, found in parts.items():
        summed, out = dict.fromkeys("ABCDE", 0), []
        for order in permutations("ABCDE"):
            left = list(found)
            for step, f in enumerate(order, 1):
                gone = [d for d in left if f in d[0]]
                left = [d for d in left if f not in d[0]]
                summed[f] += len(gone)
                out.append((f, part, "".join(order), step, len(left), len(gone), sum(f in d[0] for d in found) - len(gone), sum(d[0] == f for d in found), sum(d[1] for d in gone), sum(d[2] for d in gone)))
        rows += [(*r[1:], summed[r[0]]) for r in out]
    return rows


@pytest.mark.parametrize("which", ["small", "nulls", "empty", "sf"])
def test_filter_audit(spark, request, which):
    d = SF if which == "sf" else request.getfixturevalue(which)
    docs = [(r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{d}/documents.parquet").collect()]
    labels = {r.doc_id: (r.quality == 1, r.toxic == 1) for r in spark.read.parquet(f"{d}/labels.parquet").collect() if r.doc_id is not None}
    assert sorted(map(tuple, A.op13_filter_audit(spark, d).collect())) == sorted(audited(docs, labels))


def test_repeated_labels_count_once(spark):
    failed = spark.createDataFrame([(1, "p", 5), (1, "p", 0), (None, "p", 1)], "doc_id long, part string, mask int")
    labels = spark.createDataFrame([(1, 1, 0), (1, None, 1), (None, 1, 1)], "doc_id long, quality int, toxic int")
    rows = {(r.filter_order, r.step): r for r in A.audit(failed, labels).collect()}
    assert rows["ABCDE", 1].removed == 2 and rows["ABCDE", 1].good_lost == rows["ABCDE", 1].toxic_lost == 1
    assert rows["CABDE", 1].shapley == 60 and rows["ABCDE", 1].shapley == 180 and rows["ABCDE", 5].kept == 1


def reading(weights, text):
    return dict(zip(T.READINGS, T.Grammar(weights).clause(text.split()), strict=True))


def test_clause_readings():
    w = {"idiot": 1.0, "scum": 0.5}
    assert reading(w, "you are an idiot")["aimed"] == 1 and reading(w, "an idiot you are")["aimed"] == 1
    assert reading(w, "what an idiot")["plain"] == 1
    assert reading(w, "you are not an idiot")["negated"] == 1 and reading(w, "she said idiot")["quoted"] == 1
    assert reading(w, "i will kill you")["threat"] == 1 and not any(reading(w, "they kill time").values())
    assert reading(w, "scum and idiot")["plain"] == 1.5
    both = reading(w, "idiot x x x x x x x scum you")
    assert both["plain"] == 1.0 and both["aimed"] == 0.5


def test_toxicity_is_the_stated_formula(spark):
    """Scores recomputed from the definition: clauses split apart, each read, summed and put through the logistic function."""
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    model = T.train(docs, labels)
    got = {r.doc_id: r.score for r in T.score_documents(docs, model).collect()}
    for r in docs.collect():
        clauses = [c for c in (re.findall(r"[^\W_]+(?:'[^\W_]+)?", x) for x in re.split(r"[.!?;:\n]", r.text.lower().replace("’", "'"))) if c]
        read = [model.grammar.clause(c) for c in clauses if set(c) & model.grammar.hot]
        total = sum(read, np.zeros(len(T.READINGS)))
        x = [*np.log1p(total), np.log1p(max([v.sum() - v[2] for v in read], default=0.0)), len(read) / max(1, len(clauses)), 1.0]
        assert abs(got[r.doc_id] - 1 / (1 + np.exp(-np.dot(x, model.weights)))) < 1e-9


def test_toxicity_accuracy(spark):
    d = "/root/testdata/sf0.01"
    truth = {r.doc_id: r.toxic for r in spark.read.parquet(f"{d}/labels.parquet").collect()}
    out = T.op12_toxicity(spark, d).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and r.predicted == (r.score >= 0.7) for r in out)
    held = [(r.predicted, truth[r.doc_id]) for r in out if r.held_out and r.doc_id in truth]
    assert np.mean([p == t for p, t in held]) >= 0.94 and not any(p > t for p, t in held)


def test_toxicity_without_labels():
    model = T.Scorer([], [])
    assert model.score("you are a stupid idiot, you moron") > 0.7 > 0.3 > model.score("a fine day") > 0 and model.score("") < 0.3
    assert model.score("x" * 1_000_000) == model.score("a fine day")
