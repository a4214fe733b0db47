"""The classifier's word vectors against counts over all documents, labelled or not."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np

from loomtext.llm import quality


def test_vectors_of_all_documents(spark, monkeypatch):
    monkeypatch.setattr(quality, "VOCABULARY", 30)
    monkeypatch.setattr(quality, "COUNTED_WORDS", 50)
    monkeypatch.setattr(quality, "CHUNK_WORDS", 100)
    rng = random.Random(3)
    word = lambda k: "".join(rng.choice("abé") for _ in range(k))
    texts = [" ".join(word(rng.randint(1, 5)) for _ in range(rng.randint(0, 60))) for _ in range(60)]
    # The words of an unlabelled document and of one too long for the training sample.
    texts += ["unlabelled word " * 40, "overlong text " * 5000, None, "", texts[0]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, quality int")

    words = [(t or "").split() for t in texts]
    freq = Counter(w for ws in words for w in ws)
    frequent = [w for w, n in sorted(freq.items(), key=lambda x: (-x[1], x[0]))[:30] if n >= 3]
    endings = Counter(w[-3:] for ws in words for w in ws if w not in frequent)
    known = [e for e, n in sorted(endings.items(), key=lambda x: (-x[1], x[0])) if n >= 2][:60]
    want = quality.Vectors(frequent, known)
    around = np.zeros((want.size, quality.DIM), np.int64)
    for ws in words:
        ids = want.ids(ws)
        for i in range(len(ids)):
            for j in range(max(0, i - 2), min(len(ids), i + 3)):
                if i != j:
                    around[ids[i]] += want.index[ids[j]]
    want.settle(around)

    got = quality.corpus_vectors(docs)
    assert got.words == want.words and got.endings == want.endings and np.array_equal(got.table, want.table)
    model = quality.train(docs, labels)
    assert model.fitted and {"unlabelled", "word", "overlong", "text"} <= model.vectors.words.keys()
