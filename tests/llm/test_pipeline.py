"""Each stage on its predecessor's rows, against brute force."""

from __future__ import annotations

import pytest

pipeline = pytest.importorskip("corpus_pipeline")

from .test_queries import SF, components_of, docs_of  # noqa: E402


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = {}
    for k, (name, stage) in enumerate(pipeline.STAGES):
        out = stage(spark, docs, SF)
        out.write.parquet(f"{tmp_path}/{k}/documents.parquet")
        docs = spark.read.parquet(f"{tmp_path}/{k}/documents.parquet")
        kept[name] = f"{tmp_path}/{k}"
    first = {i for i, _, _ in docs_of(spark, kept["quality classifier"])}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    good = [i for i, q in labels.items() if q == 1]
    assert sum(i in first for i in good) >= 0.9 * len(good)
    found = components_of(docs_of(spark, kept["quality classifier"]), 80)
    assert {i for i, _, _ in docs_of(spark, kept["near-duplicates"])} == {r[0] for r in found if r[3]}
    before = {i: t for i, t, _ in docs_of(spark, kept["near-duplicates"])}
    after = {i: t for i, t, _ in docs_of(spark, kept["suffix-array dedup"])}
    assert before.keys() == after.keys()
    seen, cut = set(), 0
    for i in sorted(before):
        raw = before[i].encode()
        again = any(raw[p : p + 50] in seen for p in range(len(raw) - 49))
        assert (after[i] == before[i]) or again
        cut += after[i] != before[i]
        seen |= {raw[p : p + 50] for p in range(len(raw) - 49)}
    assert cut
    words = lambda d: sum(len(t.split()) for _, t, _ in docs_of(spark, kept[d]))
    assert abs(words("source mixing") - words("suffix-array dedup")) <= 20
    assert docs.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]


def test_run_on_empty_null_and_clashing_tables(spark, empty, nulls, small):
    assert pipeline.run(spark, empty).collect() == []
    for d in (nulls, small):
        assert pipeline.run(spark, d).count() > 0
