"""Scores of aligned sentence arrays: relevance and sentiment, entailment summaries, array merges."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, x: a + x)


def sentence_score(counts: Column, labels: Column, weighted: bool = True) -> Column:
    """Mean label of the relevant sentences (count > 0), weighted by their counts or not; null without such, or where
    the arrays are empty or of unequal length."""
    relevant = F.size(F.filter(counts, lambda c: c > 0))
    weigh = (lambda c, x: c * x) if weighted else (lambda c, x: F.when(c > 0, x).otherwise(0))
    dot = _total(F.zip_with(counts, labels, lambda c, x: weigh(c, x).cast("double")))
    return F.when((F.size(counts) == F.size(labels)) & (relevant > 0), dot / relevant)


def net_score(counts: Column, labels: Column) -> Column:
    """Sum of the labels of the relevant sentences; null where the arrays are empty or of unequal length."""
    total = _total(F.zip_with(counts, labels, lambda c, x: F.when(c > 0, x).otherwise(0).cast("double")))
    return F.when((F.size(counts) == F.size(labels)) & (F.size(counts) > 0), total)


def relevance(counts: Column) -> Column:
    """Share of relevant sentences; null for an empty section."""
    return F.when(F.size(counts) > 0, F.size(F.filter(counts, lambda c: c > 0)) / F.size(counts))


def times_relevance(score: Column, rel: Column) -> Column:
    """Null where the score is 0 or null."""
    return F.when(score != 0, score * rel)


def suite(counts: Column, labels: Column, weights: Column) -> dict[str, Column]:
    """All relevance figures of one topic in one section; ``weights``: distinct words matched in each sentence."""
    rel, plain, weighted = relevance(counts), sentence_score(counts, labels, False), sentence_score(weights, labels, True)
    return {
        "relevance": rel, "sent": plain, "sent_rel": times_relevance(plain, rel), "sent_weight": weighted,
        "sent_weight_rel": times_relevance(weighted, rel), "net_sent": net_score(counts, labels),
    }


def section_sentiment(labels: Column) -> dict[str, Column]:
    """(pos - neg) / n with the counts; nulls and 0 for an empty section."""
    pos, neg, n = F.size(F.filter(labels, lambda x: x == 1)), F.size(F.filter(labels, lambda x: x == -1)), F.size(labels)
    some = n > 0
    return {"sentiment": F.when(some, (pos - neg) / n), "n_pos": F.when(some, pos), "n_neg": F.when(some, neg), "n_sents": n}


def argmax_label(pos: Column, neu: Column, neg: Column, order: tuple[str, ...] = ("pos", "neu", "neg")) -> Column:
    """1, 0 or -1 for each sentence; ties go to the first in ``order``; an empty list where one of the three is."""
    values = {"pos": ("p", 1), "neu": ("n", 0), "neg": ("g", -1)}

    def pick(z: Column) -> Column:
        best = F.greatest(z["p"], z["n"], z["g"])
        chosen = F.when(z[values[order[0]][0]] == best, F.lit(values[order[0]][1])).when(z[values[order[1]][0]] == best, F.lit(values[order[1]][1]))
        return chosen.otherwise(F.lit(values[order[2]][1]))

    zipped = F.transform(F.arrays_zip(pos.alias("p"), neu.alias("n"), neg.alias("g")), lambda z: F.struct(z["p"].alias("p"), z["n"].alias("n"), z["g"].alias("g")))
    return F.when((F.size(pos) > 0) & (F.size(neu) > 0) & (F.size(neg) > 0), F.transform(zipped, pick)).otherwise(F.array().cast("array<int>"))


def over_threshold(scores: Column, threshold: float) -> Column:
    return F.transform(scores, lambda s: (s > threshold).cast("int"))


def entailment_summary(scores: Column, threshold: float) -> dict[str, Column]:
    """Count and share of the scores over the threshold; nulls for an empty section. The share has four decimals."""
    hits, n = F.size(F.filter(scores, lambda s: s > threshold)), F.size(scores)
    return {"nli_count": F.when(n > 0, hits), "nli_rel": F.when(n > 0, F.round(hits / n, 4)), "nli_total": over_threshold(scores, threshold), "nli_score": F.transform(scores, lambda s: F.round(s, 4))}


def matched(sents: Column, flags: Column) -> Column:
    both = F.filter(F.zip_with(sents, flags, lambda s, f: F.struct(s.alias("s"), f.alias("f"))), lambda z: z["f"] == 1)
    return F.transform(both, lambda z: z["s"])


def concatenated(a: Column, b: Column, kind: str) -> Column:
    none = F.array().cast(f"array<{kind}>")
    return F.concat(F.coalesce(a, none), F.coalesce(b, none))


def null_if_empty(a: Column) -> Column:
    return F.when(F.size(a) > 0, a)


NO_MATCH = "NO_MATCH"


def merged_counts(maps: Column) -> Column:
    """Sum by key of an array of count maps without zero entries; {NO_MATCH: 1} where none is left."""
    add = lambda a, m: F.map_zip_with(a, m, lambda k, x, y: F.coalesce(x, F.lit(0)) + F.coalesce(y, F.lit(0)))
    total = F.map_filter(F.aggregate(maps, F.expr("cast(map() as map<string,int>)"), add), lambda k, v: v > 0)
    return F.when(F.coalesce(F.size(total), F.lit(0)) > 0, total).otherwise(F.create_map(F.lit(NO_MATCH), F.lit(1)))


def merged_counts_with_zeros(maps: Column) -> Column:
    """The legacy sum by key, which keeps zeros; {ERROR: 1} for an empty list and {NO_MATCH: 1} where there is no key."""
    add = lambda a, m: F.map_zip_with(a, m, lambda k, x, y: F.coalesce(x, F.lit(0)) + F.coalesce(y, F.lit(0)))
    total = F.aggregate(maps, F.expr("cast(map() as map<string,int>)"), add)
    return F.when(F.size(maps) == 0, F.create_map(F.lit("ERROR"), F.lit(1))).when(F.size(total) == 0, F.create_map(F.lit(NO_MATCH), F.lit(1))).otherwise(total)


def without_nulls(counts: Column) -> Column:
    return F.transform_values(F.map_filter(counts, lambda k, v: v.isNotNull()), lambda k, v: v.cast("int"))


def text_pairs(sents: Column, labels: Column) -> Column:
    """Every sentence with every label, sentence by sentence, as (text, label)."""
    return F.flatten(F.transform(sents, lambda s: F.transform(labels, lambda x: F.struct(s.alias("text"), x.alias("label")))))


def softmax(logits: Column) -> Column:
    e = F.transform(logits, lambda x: F.exp(x - F.array_max(logits)))
    return F.transform(e, lambda x: x / _total(e))


def stub_score(*key: Column) -> Column:
    """A score in [0, 1) from a hash, in place of a model's."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", *[k.cast("string") for k in key])), 1, 7), 16, 10).cast("double") / float(16**7)
