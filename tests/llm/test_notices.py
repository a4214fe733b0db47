"""Labels of files with several notices, against every start of every template."""

from __future__ import annotations

import re

from loomtext.llm.licenses import BASE, MIN_COVERAGE, TEMPLATES

from .test_queries import Q, SF, UPPER, docs_of

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
SCHEMA = "doc_id long, text string"


def notices():
    """Every pair of notices in a file, all of them in one, and cut and interrupted ones."""
    whole = [t.text for t in TEMPLATES]
    w = whole[10].split()
    return [
        *[f"{a}. Some words between.\n{b.upper()}." for a in whole for b in whole], "\n".join(whole), "\n".join(reversed(whole)), " ".join(w[:-3]), " ".join(w[2:]),
        " ".join(w[:8] + ["of"] * 40 + w), "all rights reserved " + "reserved " * 500 + whole[8], "free and unencumbered software", "all rights reserved " * 30 + " ".join(whole),
    ]


def by_force(text):
    words = WORD.findall(text.translate(UPPER))
    spaced = " " + " ".join(words) + " "
    base = {label for label, p in BASE.items() if f" {p} " in spaced}
    # A start counts only if the template's key phrases stand in their own places after it.
    holds = lambda s, tw, p: any(tw[k : k + len(p)] == p and s + k >= 0 and words[s + k : s + k + len(p)] == p for k in range(len(tw)))
    found = {}
    for t in TEMPLATES:
        tw = t.text.split()
        starts = [s for s in range(1 - len(tw), len(words)) if all(holds(s, tw, p.split()) for p in t.key_phrases)]
        if starts:
            best = max(sum(0 <= s + k < len(words) and words[s + k] == x for k, x in enumerate(tw)) for s in starts) / len(tw)
            if best >= MIN_COVERAGE:
                found[t.label] = best
    return ",".join(sorted(base | found.keys())), 1.0 if base else max(found.values(), default=0.0)


def test_labels_of_several_notices(spark, tmp_path):
    rows = list(enumerate(notices()))
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: (r.labels, r.score) for r in Q["op7_licenses"](spark, str(tmp_path)).collect()}
    assert got == {i: by_force(t) for i, t in rows}


def test_labels_of_given_table(spark):
    got = {r.doc_id: (r.labels, r.score) for r in Q["op7_licenses"](spark, SF).collect()}
    assert got == {i: by_force(t) for i, t, _ in docs_of(spark, SF)}
