"""Evaluation of predictions: confusion counts, precision and recall, thresholds, AUC, rank correlation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def confusion(df: DataFrame, truth: str, predicted: str, *by: str) -> DataFrame:
    def count(t: int, p: int) -> Column:
        return F.count_if((F.col(truth) == t) & (F.col(predicted) == p))

    return df.groupBy(*by).agg(count(1, 1).alias("tp"), count(0, 1).alias("fp"), count(1, 0).alias("fn"), count(0, 0).alias("tn"))


def rates(counts: DataFrame) -> DataFrame:
    """Accuracy, precision, recall and F1 of confusion counts; 0 where the denominator is."""
    over = lambda a, b: F.coalesce(F.try_divide(F.expr(a), F.expr(b)), F.lit(0.0))
    return counts.withColumns({"accuracy": over("tp + tn", "tp + fp + fn + tn"), "precision": over("tp", "tp + fp"), "recall": over("tp", "tp + fn"), "f1": over("2 * tp", "2 * tp + fp + fn")})


def accuracy_at(df: DataFrame, truth: str, score: str, thresholds: list[float]) -> DataFrame:
    """Accuracy of score > threshold for each threshold."""
    t = F.explode(F.array(*[F.lit(x) for x in thresholds])).alias("threshold")
    return df.select(truth, score, t).groupBy("threshold").agg(F.avg(((F.col(score) > F.col("threshold")).cast("int") == F.col(truth)).cast("int")).alias("accuracy"))


def share_below(df: DataFrame, score: str, thresholds: list[float], *by: str) -> DataFrame:
    t = F.explode(F.array(*[F.lit(x) for x in thresholds])).alias("threshold")
    return df.select(*by, score, t).groupBy(*by, "threshold").agg(F.avg((F.col(score) < F.col("threshold")).cast("int")).alias("share"))


#: Rows to a range of a ranked column, and most ranges it is cut into.
RANGE_ROWS, RANK_RANGES = 2_000_000, 1024


#: Most distinct values whose ranks are broadcast: some 10 MB.
BROADCAST_RANKS = 100_000


def ranked(counts: DataFrame, value: str, n: str, name: str) -> DataFrame:
    """``counts`` (a row for each distinct ``value``, standing ``n`` times) with its rank from 1, ties sharing their mean.

    Values are cut into ranges at approximate quantiles (a bounded list), so that no task orders more than a range; the
    ranges' own counts give each its first rank.
    """
    parts, cuts = min(RANK_RANGES, -(-counts.count() // RANGE_ROWS)), []
    if parts > 1:
        at = [k / parts for k in range(1, parts)]
        cuts = sorted(set(counts.agg(F.percentile_approx(F.col(value).cast("double"), at, 10 * RANK_RANGES)).first()[0] or []))

    def below(lo: int, hi: int) -> Column:
        """Number of cuts under the value, by halves: plain comparisons, which are compiled."""
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(F.col(value) > cuts[mid], below(mid + 1, hi)).otherwise(below(lo, mid))

    rows = counts.withColumn("_range", below(0, len(cuts)))
    # One row for each range, at most RANK_RANGES.
    first = rows.groupBy("_range").agg(F.sum(n).alias("_all")).withColumn("_first", F.sum("_all").over(Window.orderBy("_range")) - F.col("_all")).drop("_all")
    before = F.sum(n).over(Window.partitionBy("_range").orderBy(value)) - F.col(n)
    ranks = rows.withColumn("_before", before).join(F.broadcast(first), "_range")
    return ranks.select(*counts.columns, (F.col("_first") + F.col("_before") + (F.col(n) + 1) / 2).alias(name))


def average_ranks(df: DataFrame, value: str, name: str) -> DataFrame:
    """``df`` with each row's rank, where rows are asked for; measures are taken from :func:`ranked` counts instead."""
    ranks = ranked(df.groupBy(value).agg(F.count(F.lit(1)).alias("_n")), value, "_n", name)
    return df.join(ranks.select(value, name), value)


def roc_auc(df: DataFrame, truth: str, score: str) -> DataFrame:
    """Area under the curve, from counts by score alone; rows without a score don't count."""
    counts = df.filter(F.col(score).isNotNull()).groupBy(F.col(score).alias("_score")).agg(F.count(F.lit(1)).alias("_n"), F.count_if(F.col(truth) == 1).alias("_pos"), F.count_if(F.col(truth) == 0).alias("_neg"))
    pos, neg = F.sum("_pos"), F.sum("_neg")
    return ranked(counts, "_score", "_n", "_rank").agg(F.try_divide(F.sum(F.when(F.col("_pos") > 0, F.col("_pos") * F.col("_rank"))) - pos * (pos + 1) / 2, pos * neg).alias("auc"))


def spearman(df: DataFrame, a: str, b: str) -> DataFrame:
    """Rank correlation of the rows that have both; null for fewer than two."""
    both = df.select(F.col(a).alias("_a"), F.col(b).alias("_b")).filter("_a is not null and _b is not null and not isnan(double(_a)) and not isnan(double(_b))")
    pairs = both.groupBy("_a", "_b").agg(F.count(F.lit(1)).alias("_n"))

    def with_rank(rows: DataFrame, value: str, name: str) -> DataFrame:
        ranks = ranked(pairs.groupBy(value).agg(F.sum("_n").alias("_m")), value, "_m", name).select(F.col(value).alias("_value"), name)
        small = ranks.limit(BROADCAST_RANKS + 1).count() <= BROADCAST_RANKS
        return rows.join(F.broadcast(ranks) if small else ranks, F.col(value) == F.col("_value")).drop("_value")

    # Ranks have a known mean, so that the sums are of differences from it.
    n = F.sum("_n")
    r = with_rank(with_rank(pairs, "_a", "_ra"), "_b", "_rb").crossJoin(F.broadcast(pairs.agg(((n + 1) / 2).alias("_mean"))))
    a, b = F.col("_ra") - F.col("_mean"), F.col("_rb") - F.col("_mean")
    spread = F.sqrt(F.sum(F.col("_n") * a * a)) * F.sqrt(F.sum(F.col("_n") * b * b))
    return r.agg(F.when(n >= 2, F.try_divide(F.sum(F.col("_n") * a * b), spread)).alias("rho"), F.coalesce(n, F.lit(0)).alias("n"))


def hash_percent(*key: Column, seed: int = 42) -> Column:
    """0 to 99 by MD5 of seed and key, the same in any engine."""
    return F.conv(F.left(F.md5(F.concat_ws("|", F.lit(str(seed)), *[k.cast("string") for k in key])), F.lit(8)), 16, 10).cast("long") % 100


def group_split(df: DataFrame, key: Column, train_percent: int = 80) -> DataFrame:
    """``df`` with ``part``: all rows of one key on one side."""
    return df.withColumn("part", F.when(hash_percent(key) < train_percent, "train").otherwise("test"))


def row_split(df: DataFrame, *columns: str, train_percent: int = 80) -> DataFrame:
    """``df`` with ``part``: each row by itself, by all its named columns."""
    return df.withColumn("part", F.when(hash_percent(*[F.col(c) for c in columns]) < train_percent, "train").otherwise("test"))


def class_report(df: DataFrame, truth: str, predicted: str, classes: list[int], *by: str) -> DataFrame:
    """(by, class, precision, recall, f1, support): each class in turn is the positive one; 0 where the denominator is."""
    c = F.explode(F.array(*[F.lit(x) for x in classes])).alias("class")
    rows = df.select(*by, truth, predicted, c)
    t, p = F.col(truth) == F.col("class"), F.col(predicted) == F.col("class")
    counts = rows.groupBy(*by, "class").agg(F.count_if(t & p).alias("tp"), F.count_if(~t & p).alias("fp"), F.count_if(t & ~p).alias("fn"), F.count_if(~t & ~p).alias("tn"), F.count_if(t).alias("support"))
    return rates(counts).select(*by, "class", "precision", "recall", "f1", "support")
