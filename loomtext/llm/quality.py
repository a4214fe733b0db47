"""Quality classifier: random-indexing word vectors pooled per document, a two-layer network, a temperature.

A word (text between white space, as written) is itself where it is frequent in the documents, else its last three
characters stand for it. Each has a sparse random index vector; its word vector adds the index vectors of the words
around its occurrences. Both the counts of words and these sums are taken over all documents, added up in the workers
first. A document is the mean of its word vectors and a few figures of its own. The network is trained on the driver
from a bounded sample of labelled rows; logits by networks that have not seen their rows set the temperature that its
logits are divided by, and a shift. Scoring reads every word of every text, a batch at a time.

Inputs of a score are the text's words only. Defined cases: a null or empty text has a zero vector and is scored like
others; without labelled rows (or with one class alone) every score is that class' share, 1.0 without any; repeated
rows get equal scores; an empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import documents, forget, materialize

#: Bounds of the training sample: labelled rows, and bytes of a text that may be in it.
SAMPLE_ROWS, SAMPLE_BYTES = 4000, 60_000
DIM, HIDDEN, NONZERO, VOCABULARY, WINDOW = 64, 32, 4, 4000, 2
EPOCHS, RATE, DECAY = 40, 3e-3, 1e-4
#: Parts that calibration holds out in turn, and rows that its prior counts for.
FOLDS, PRIOR_ROWS = 3, 0.5
THRESHOLD = 0.7
FIGURES = 4
#: Different words that a worker counts before it hands them on, and words whose surroundings are added up at once.
COUNTED_WORDS, CHUNK_WORDS = 200_000, 100_000


def held_out(doc_id) -> Column:
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2


class Vectors:
    """Word vectors by random indexing, with endings for words outside the vocabulary."""

    def __init__(self, frequent: list[str], endings: list[str], seed: int = 7):
        self.words = {w: i for i, w in enumerate(frequent)}
        self.endings = {e: len(frequent) + i for i, e in enumerate(endings)}
        self.size = len(frequent) + len(endings) + 1  # the last is for unknown endings
        rng = np.random.default_rng(seed)
        self.index = np.zeros((self.size, DIM), np.int64)
        for i in range(self.size):
            self.index[i, rng.choice(DIM, NONZERO, replace=False)] = rng.choice([-1, 1], NONZERO)
        self.table = None

    def surroundings(self, texts) -> np.ndarray:
        """For each word, the sum of the index vectors around its occurrences: whole numbers, so in any order the same."""
        # Row ``size`` is a gap between texts, which adds nothing.
        places = np.zeros((self.size + 1, NONZERO), np.int64)
        signs = np.zeros((self.size + 1, NONZERO))
        places[:-1] = np.nonzero(self.index)[1].reshape(-1, NONZERO)
        signs[:-1] = np.take_along_axis(self.index, places[:-1], 1)
        around, gap = np.zeros((self.size + 1) * DIM, np.int64), np.full(WINDOW, self.size)

        def add(parts: list[np.ndarray]) -> None:
            ids = np.concatenate(parts)
            # In steps by a pair's first word, so that a long text isn't worked on at once.
            for at in range(0, len(ids), CHUNK_WORDS):
                keys, values = [], []
                for d in range(1, WINDOW + 1):
                    after = ids[at + d : at + CHUNK_WORDS + d]
                    before = ids[at : at + len(after)]
                    for here, there in ((before, after), (after, before)):
                        keys.append((here[:, None] * DIM + places[there]).ravel())
                        values.append(signs[there].ravel())
                around[:] += np.rint(np.bincount(np.concatenate(keys), np.concatenate(values), len(around))).astype(np.int64)

        parts, n = [], 0
        for t in texts:
            ids = self.ids(t.split())
            parts += [ids, gap]
            n += len(ids)
            if n >= CHUNK_WORDS:
                add(parts)
                parts, n = [], 0
        if parts:
            add(parts)
        return around.reshape(-1, DIM)[:-1]

    def settle(self, around: np.ndarray) -> None:
        """Make the word vectors of what stands around the words."""
        around = around.astype(np.float32)
        norm = np.linalg.norm(around, axis=1, keepdims=True)
        self.table = self.index.astype(np.float32) + np.divide(around, norm, out=np.zeros_like(around), where=norm > 0)
        self.index = None

    def ids(self, words: list[str]) -> np.ndarray:
        known, endings, last = self.words.get, self.endings.get, self.size - 1
        found = [known(w) for w in words]
        if None in found:
            found = [endings(w[-3:], last) if i is None else i for i, w in zip(found, words, strict=True)]
        return np.array(found, np.int64)

    def pooled(self, texts: list[str], table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Mean of each text's rows of ``table``, and its figures."""
        words = [t.split() for t in texts]
        counts = np.array([len(w) for w in words])
        out, figures = np.zeros((len(texts), table.shape[1]), np.float32), np.zeros((len(texts), FIGURES), np.float32)
        full = np.flatnonzero(counts)
        if len(full):
            starts = np.concatenate([[0], np.cumsum(counts[full])[:-1]])
            ids = np.concatenate([self.ids(words[i]) for i in full])
            # In steps of whole documents, so that a batch of long texts doesn't gather its rows all at once.
            at = 0
            while at < len(full):
                to = max(at + 1, int(np.searchsorted(starts, starts[at] + 200_000)))
                stop = starts[to] if to < len(full) else len(ids)
                sums = np.add.reduceat(table[ids[starts[at] : stop]], starts[at:to] - starts[at], axis=0)
                out[full[at:to]] = sums / counts[full[at:to], None]
                at = to
            for i in full:
                w, t = words[i], texts[i]
                figures[i] = (np.log1p(len(w)) / 5, len(set(w)) / len(w), len(t) / len(w) / 10, (t.count("\n") + 1) / len(w))
        return out, figures


class Network:
    """Two layers (tanh, logistic) on pooled vectors and figures, trained by Adam."""

    def __init__(self, x: np.ndarray, y: np.ndarray, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.mean, self.scale = x.mean(0), x.std(0) + 1e-3
        z = (x - self.mean) / self.scale
        self.w1, self.b1 = rng.normal(0, z.shape[1] ** -0.5, (z.shape[1], HIDDEN)), np.zeros(HIDDEN)
        self.w2, self.b2 = rng.normal(0, HIDDEN**-0.5, HIDDEN), 0.0
        # Classes count alike in training; the temperature and shift put the probabilities right.
        weight = np.where(y == 1, 0.5 / max(y.mean(), 1e-6), 0.5 / max(1 - y.mean(), 1e-6))
        m = [np.zeros_like(p) for p in (self.w1, self.b1, self.w2, np.zeros(1))]
        v = [np.zeros_like(p) for p in m]
        step = 0
        for _ in range(EPOCHS):
            for _ in range(0, len(z), 64):
                some = rng.choice(len(z), min(64, len(z)), replace=False)
                a, h = z[some], np.tanh(z[some] @ self.w1 + self.b1)
                err = (1 / (1 + np.exp(-np.clip(h @ self.w2 + self.b2, -40, 40))) - y[some]) * weight[some] / len(some)
                back = np.outer(err, self.w2) * (1 - h * h)
                grads = [a.T @ back + DECAY * self.w1, back.sum(0), h.T @ err + DECAY * self.w2, np.array([err.sum()])]
                step += 1
                params = [self.w1, self.b1, self.w2, np.array([self.b2])]
                for k, (p, g) in enumerate(zip(params, grads, strict=True)):
                    m[k] = 0.9 * m[k] + 0.1 * g
                    v[k] = 0.999 * v[k] + 0.001 * g * g
                    p -= RATE * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
                self.b2 = float(params[3][0])

    def logit(self, x: np.ndarray) -> np.ndarray:
        return np.tanh((x - self.mean) / self.scale @ self.w1 + self.b1) @ self.w2 + self.b2


def unseen_logits(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Every row's logit by a network that has not seen it."""
    fold = np.random.default_rng(5).permutation(len(y)) % min(FOLDS, len(y))
    out = np.zeros(len(y))
    for k in range(fold.max() + 1):
        out[fold == k] = Network(x[fold != k], y[fold != k]).logit(x[fold == k])
    return out


def calibrated(logit: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Temperature and shift of least log loss, by Newton's method.

    The loss has PRIOR_ROWS times the squared distance of (1 / temperature, shift) from (1, 0) added, so that it has
    one optimum however few the rows are; an inverse temperature below 1 / 64 is taken for that.
    """
    a, b = 1.0, 0.0
    x = np.column_stack([np.clip(logit, -40, 40), np.ones(len(y))])

    def loss(a, b):
        z = x @ (a, b)
        return np.logaddexp(0, z).sum() - (y * z).sum() + PRIOR_ROWS * ((a - 1) ** 2 + b**2)

    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ (a, b), -40, 40)))
        step = np.linalg.solve((x.T * (p * (1 - p))) @ x + 2 * PRIOR_ROWS * np.eye(2), x.T @ (p - y) + 2 * PRIOR_ROWS * np.array([a - 1, b]))
        size = 1.0
        while size > 1e-6 and loss(a - size * step[0], b - size * step[1]) > loss(a, b):
            size /= 2
        a, b = a - size * step[0], b - size * step[1]
        if np.abs(step).max() < 1e-9:
            break
    return 1 / max(a, 1 / 64), float(b)


class Classifier:
    """``vectors`` is called for the word vectors if there are labels of both classes."""

    def __init__(self, texts: list[str], labels: list[int], vectors: Callable[[], Vectors]):
        y = np.array(labels, float)
        self.constant = float(y.mean()) if len(y) else 1.0
        self.fitted = 0 < self.constant < 1
        if self.fitted:
            self.vectors = vectors()
            mean, figures = self.vectors.pooled(texts, self.vectors.table)
            x = np.hstack([mean, figures])
            net = Network(x, y)
            self.temperature, self.shift = calibrated(unseen_logits(x, y), y)
            # The first layer is linear in the mean, so it is applied to the word vectors once.
            w = net.w1 / net.scale[:, None]
            self.table = (self.vectors.table @ w[:DIM]).astype(np.float32)
            self.vectors.table = None
            self.figures, self.bias = w[DIM:], net.b1 - net.mean @ w
            self.w2, self.b2 = net.w2, net.b2

    def score(self, texts: list[str]) -> np.ndarray:
        if not self.fitted:
            return np.full(len(texts), self.constant)
        mean, figures = self.vectors.pooled(texts, self.table)
        logit = np.tanh(mean + figures @ self.figures + self.bias) @ self.w2 + self.b2
        return 1 / (1 + np.exp(-np.clip(logit / self.temperature + self.shift, -40, 40)))


def word_counts(bodies: DataFrame) -> DataFrame:
    """(word, n) over all texts of the one column of ``bodies``."""

    def run(batches):
        counts: Counter[str] = Counter()

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], ["word", "n"])

        for batch in batches:
            for t in batch.column(0):
                counts.update(t.as_py().split())
                if len(counts) > COUNTED_WORDS:
                    yield out()
                    counts.clear()
        yield out()

    return bodies.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def corpus_vectors(docs: DataFrame, text: str = "text") -> Vectors:
    """Word vectors of all documents. What comes to the driver is bounded by the vocabulary."""
    bodies = docs.select(F.coalesce(F.col(text), F.lit("")).alias("body"))
    counts = materialize(word_counts(bodies), "quality-words")
    frequent = [r["word"] for r in counts.filter("n >= 3").orderBy(F.col("n").desc(), "word").limit(VOCABULARY).collect()]
    common = docs.sparkSession.createDataFrame([(w,) for w in frequent], "word string")
    rest = counts.join(F.broadcast(common), "word", "left_anti")
    endings = rest.groupBy(F.right("word", F.lit(3)).alias("ending")).agg(F.sum("n").alias("n")).filter("n >= 2")
    known = [r["ending"] for r in endings.orderBy(F.col("n").desc(), "ending").limit(2 * VOCABULARY).collect()]
    forget(counts)
    vectors, dims = Vectors(frequent, known), [f"v{k}" for k in range(DIM)]

    def run(batches):
        around = vectors.surroundings(t.as_py() for batch in batches for t in batch.column(0))
        some = np.flatnonzero(around.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), *[pa.array(around[some, k]) for k in range(DIM)]], ["id", *dims])

    sums = bodies.mapInArrow(run, "id long, " + ", ".join(f"{v} long" for v in dims)).groupBy("id").agg(*[F.sum(v).alias(v) for v in dims])
    around = np.zeros((vectors.size, DIM), np.int64)
    for r in sums.collect():
        around[r[0]] = r[1:]
    vectors.settle(around)
    return vectors


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> Classifier:
    """Word vectors of all documents; the network is fit on the rows of smallest hash among those that are labelled and not held out."""
    known = labels.filter(F.col("quality").isNotNull() & ~F.coalesce(held_out("doc_id"), F.lit(True))).select(F.col("doc_id").alias("label_id"), F.col("quality").cast("int").alias("quality"))
    known = known.orderBy(F.xxhash64("label_id"), "label_id").limit(SAMPLE_ROWS)  # bounded, so it may be broadcast
    body = docs.select(F.col(key).alias("label_id"), F.coalesce(F.col(text), F.lit("")).alias("body")).filter(F.octet_length("body") <= SAMPLE_BYTES)
    rows = body.join(F.broadcast(known), "label_id").orderBy("label_id", "quality", "body").limit(SAMPLE_ROWS).collect()
    return Classifier([r["body"] for r in rows], [r["quality"] for r in rows], lambda: corpus_vectors(docs, text))


def score_documents(df: DataFrame, model: Classifier, text: str = "text", name: str = "score") -> DataFrame:
    """``df`` with a column ``name``, which it must not have yet."""
    at = df.columns.index(text)
    schema = df.withColumn(name, F.lit(0.0)).schema

    def run(batches):
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                b = batch.slice(k, 256)
                scores = model.score([t or "" for t in b.column(at).to_pylist()])
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(scores, pa.float64())], [*b.schema.names, name])

    return df.mapInArrow(run, schema)


def op2_quality(spark, sf_dir):
    docs = documents(spark, sf_dir).select("doc_id", "text")
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score_documents(docs, model).select("doc_id", F.coalesce(held_out("doc_id"), F.lit(False)).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
