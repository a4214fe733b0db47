"""Toxicity: a weighted finite-state grammar of clauses, its weights fitted to labelled documents.

A text is cut into clauses at sentence marks, semicolons, colons and line ends. Words become symbols: insult (with the
word's own weight), threat, target (whom it is said to), negation, report (somebody else's words). Four small transducers
read a clause's symbols: targets mark the insults and threats that stand within four words of them, negations cancel
those that follow within three words, and a report turns the rest of its clause into quoted speech. Their composition
maps a clause to the weight of each of its readings: plain, aimed, negated, quoted insults, and threats. A document's
reading is the sum over its clauses, its strongest clause, and the share of clauses that matched; a logistic function of
these, fitted with a prior that keeps the readings' order, gives the score.

Insults are a stated list and the words that labelled documents tell to be of the kind: both their weights come from the
labels (at most 4,000 labelled rows of at most 60,000 bytes, those of smallest hash that are not held out), by a
likelihood-ratio test that few chance words pass. Clauses without insult or threat read as nothing and are not walked.

Defined cases: a null or empty text has no clauses and gets the score of one without a match; without labels of both
classes the grammar keeps its stated weights; repeated rows get equal scores; an empty table gives an empty result;
further columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import documents

SAMPLE_ROWS, SAMPLE_BYTES = 4000, 60_000
THRESHOLD = 0.7
#: A word is learned as an insult at this log-likelihood ratio, in this many toxic documents, at most so many words.
MIN_RATIO, MIN_TOXIC, LEARNED_WORDS = 25.0, 4, 500
AIM, REACH = 4, 3
TARGETS = frozenset("you your yours yourself yourselves u ur he him his she her hers they them their theirs everyone people".split())
NEGATIONS = frozenset("not no never nobody none isn't aren't wasn't weren't don't doesn't didn't cannot can't nor without hardly".split())
REPORTS = frozenset("said says say wrote writes claimed claims called calls reported alleged quoted according accused".split())
THREATS = frozenset("kill murder hurt destroy strangle beat burn shoot stab punish crush hang attack".split())
INSULTS = frozenset(
    "idiot idiots idiotic moron morons moronic stupid dumb fool fools foolish loser losers scum trash garbage worthless pathetic disgusting clown clowns "
    "imbecile jerk creep freak pig coward liar ugly useless vermin filth parasite lunatic dimwit disgrace".split()
)
READINGS = ("plain", "aimed", "negated", "quoted", "threat")
#: Stated weights of readings, their strongest clause and the matched share, and the bias: prior of the fit.
PRIOR = np.array([1.5, 2.0, 0.3, 0.5, 1.0, 1.0, 1.0, -3.0])
PRIOR_STRENGTH = 0.5

WORD = re.compile(r"[^\W_]+(?:'[^\W_]+)?|[.!?;:\n]")
MARKS = frozenset(".!?;:\n")


class Grammar:
    """The composed transducers; ``weights`` are the insults'."""

    def __init__(self, weights: dict[str, float]):
        self.weights = weights
        self.hot = frozenset(weights) | THREATS

    def clause(self, words: list[str]) -> np.ndarray:
        """Weights of one clause's readings, read from left to right with the composed state (target, negation, report)."""
        out = dict.fromkeys(READINGS, 0.0)
        since_target = since_negation = AIM + REACH + 1
        quoted = False
        open_hits: list[tuple[int, str, float]] = []  # those that a later target may still aim at
        for k, w in enumerate(words):
            since_target, since_negation = since_target + 1, since_negation + 1
            if w in TARGETS:
                since_target = 0
                for at, reading, weight in open_hits:
                    if k - at <= AIM:
                        out[reading] -= weight
                        out["aimed" if reading == "plain" else reading] += weight
                open_hits = []
            elif w in NEGATIONS:
                since_negation = 0
            elif w in REPORTS:
                quoted = True
            if w not in self.hot:
                continue
            insult = w in self.weights
            weight = self.weights.get(w, 1.0)
            if since_negation <= REACH:
                reading = "negated"
            elif quoted:
                reading = "quoted"
            elif not insult:
                # A threat needs somebody it is meant for.
                reading = "threat" if any(x in TARGETS for x in words[k + 1 : k + 1 + AIM]) else ""
            else:
                reading = "aimed" if since_target <= AIM else "plain"
            if reading:
                out[reading] += weight
                if reading == "plain":
                    open_hits.append((k, reading, weight))
        return np.array([out[r] for r in READINGS])

    def features(self, text: str) -> np.ndarray:
        total, strongest, matched, clauses = np.zeros(len(READINGS)), 0.0, 0, 0
        tokens = WORD.findall(text.lower().replace("’", "'"))
        start, hit = 0, False
        for k, w in enumerate(tokens):
            if w in MARKS:
                if k > start:
                    clauses += 1
                    if hit:
                        read = self.clause(tokens[start:k])
                        total += read
                        strongest = max(strongest, float(read.sum() - read[2]))
                        matched += 1
                start, hit = k + 1, False
            elif w in self.hot:
                hit = True
        if len(tokens) > start:
            clauses += 1
            if hit:
                read = self.clause(tokens[start:])
                total += read
                strongest = max(strongest, float(read.sum() - read[2]))
                matched += 1
        return np.array([*np.log1p(total), np.log1p(strongest), matched / max(1, clauses), 1.0])


def insult_weights(texts: list[str], labels: list[int]) -> dict[str, float]:
    """Weights of the stated insults, and of the words that stand in toxic documents far more often than by chance."""
    n = [labels.count(0), labels.count(1)]
    stated = dict.fromkeys(INSULTS, 1.0)
    if not n[0] or not n[1]:
        return stated
    seen = [Counter(), Counter()]
    for t, y in zip(texts, labels, strict=True):
        seen[y].update(set(WORD.findall(t.lower().replace("’", "'"))) - MARKS)
    base = n[1] / sum(n)
    found = []
    for w, k in seen[1].items():
        other = seen[0][w]
        rate = k / (k + other)
        if k < MIN_TOXIC or rate <= base:
            continue
        ratio = 2 * (k * np.log(rate / base) + (other * np.log((1 - rate) / (1 - base)) if other else 0.0))
        if ratio >= MIN_RATIO:
            found.append((-ratio, w))
    for w in [w for _, w in sorted(found)[:LEARNED_WORDS]] + sorted(INSULTS):
        k, other = seen[1][w], seen[0][w]
        # Documents of each class by rate, with one of the toxic class added for a stated word; half weight if clean texts use it as much.
        prior = 2.0 if w in INSULTS else 0.0
        odds = np.log((k + prior + 0.5) / (n[1] + 1)) - np.log((other + 0.5) / (n[0] + 1)) if k + other else 1.5
        stated[w] = float(np.clip(odds / 3.0, 0.0, 2.0))
    return stated


def fit(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Logistic weights of least loss about PRIOR, by Newton's method with halved steps."""
    w = PRIOR.copy()

    def loss(w):
        z = x @ w
        return np.logaddexp(0, z).sum() - y @ z + PRIOR_STRENGTH * ((w - PRIOR) ** 2).sum()

    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))
        step = np.linalg.solve((x.T * (p * (1 - p))) @ x + 2 * PRIOR_STRENGTH * np.eye(len(w)), x.T @ (p - y) + 2 * PRIOR_STRENGTH * (w - PRIOR))
        size = 1.0
        while size > 1e-6 and loss(w - size * step) > loss(w):
            size /= 2
        w = w - size * step
        if np.abs(step).max() < 1e-9:
            break
    return w


class Scorer:
    def __init__(self, texts: list[str], labels: list[int]):
        self.grammar = Grammar(insult_weights(texts, labels))
        self.weights = PRIOR
        if 0 < sum(labels) < len(labels):
            self.weights = fit(np.array([self.grammar.features(t) for t in texts]), np.array(labels, float))

    def score(self, text: str) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.grammar.features(text) @ self.weights, -40, 40))))


def held_out(key: str) -> Column:
    return F.crc32(F.encode(F.col(key).cast("string"), "UTF-8")) % 3 == 1


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> Scorer:
    """Fit on the labelled rows of smallest hash that are not held out, at most SAMPLE_ROWS."""
    known = labels.filter(F.col("toxic").isin(0, 1) & ~F.coalesce(held_out("doc_id"), F.lit(True))).select(F.col("doc_id").alias("label_id"), F.col("toxic").cast("int").alias("toxic"))
    known = known.orderBy(F.xxhash64("label_id"), "label_id").limit(SAMPLE_ROWS)  # bounded, so it may be broadcast
    body = docs.select(F.col(key).alias("label_id"), F.coalesce(F.col(text), F.lit("")).alias("body")).filter(F.octet_length("body") <= SAMPLE_BYTES)
    rows = body.join(F.broadcast(known), "label_id").orderBy("label_id", "toxic", "body").limit(SAMPLE_ROWS).collect()
    return Scorer([r["body"] for r in rows], [r["toxic"] for r in rows])


def score_documents(docs: DataFrame, model: Scorer) -> DataFrame:
    """(doc_id, score) of every row."""

    def run(batches):
        for batch in batches:
            scores = [model.score(t or "") for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], ["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, score double")


def op12_toxicity(spark, sf_dir):
    docs = documents(spark, sf_dir).select("doc_id", "text")
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = score_documents(docs, model)
    return scored.select("doc_id", F.coalesce(held_out("doc_id"), F.lit(False)).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
