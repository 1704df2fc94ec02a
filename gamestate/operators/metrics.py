"""Evaluation of scored rows (label 0/1, score), and reports on columns, as aggregates and windows."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _by_score(df: DataFrame, label: str, score: str) -> DataFrame:
    """Positives and negatives of each distinct score: everything below needs no more than this."""
    return df.groupBy(F.col(score).alias("score")).agg(F.sum(F.col(label)).alias("pos"), F.sum(1 - F.col(label)).alias("neg"))


def _cumulative(df: DataFrame, label: str, score: str, parts: int = 64) -> DataFrame:
    """Positives and negatives at or above each score, without one task for all scores.

    Scores are cut into ranges; sums within a range come from windows, those of the ranges above from a small table. P and
    N are all positives and negatives. Everything follows from the aggregation by score, whose shuffle is made once.
    """
    by = _by_score(df, label, score)
    cuts = by.agg(F.percentile_approx("score", F.array(*[F.lit(i / parts) for i in range(1, parts)]), F.lit(parts * 100)).alias("cuts"))
    by = by.crossJoin(F.broadcast(cuts)).withColumn("part", F.size(F.filter("cuts", lambda c: c <= F.col("score")))).drop("cuts")
    sums = by.groupBy("part").agg(F.sum("pos").alias("p"), F.sum("neg").alias("n"))  # at most `parts` rows
    higher = sums.alias("a").join(sums.alias("b"), F.col("b.part") > F.col("a.part"), "left").groupBy(F.col("a.part").alias("part")).agg(F.coalesce(F.sum("b.p"), F.lit(0)).alias("above_p"), F.coalesce(F.sum("b.n"), F.lit(0)).alias("above_n"))
    w = Window.partitionBy("part").orderBy(F.desc("score"))
    total = sums.agg(F.sum("p").alias("P"), F.sum("n").alias("N"))
    out = by.join(F.broadcast(higher), "part").crossJoin(F.broadcast(total))
    return out.select("score", "pos", "neg", "P", "N", (F.sum("pos").over(w) + F.col("above_p")).alias("tp"), (F.sum("neg").over(w) + F.col("above_n")).alias("fp"))


def roc(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """threshold, tpr, fpr for each distinct score."""
    c = _cumulative(df, label, score)
    return c.select(F.col("score").alias("threshold"), F.try_divide(F.col("tp"), F.col("P").cast("double")).alias("tpr"), F.try_divide(F.col("fp"), F.col("N").cast("double")).alias("fpr"))


def youden(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """The threshold with the largest tpr - fpr; of equals the highest."""
    r = roc(df, label, score).withColumn("j", F.col("tpr") - F.col("fpr"))
    return r.agg(F.max_by("threshold", F.struct(F.round("j", 12), "threshold")).alias("threshold"), F.max("j").alias("j"))


def auc(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """Area under the ROC curve: a positive beats the negatives below it, and half of those of its score."""
    c = _cumulative(df, label, score)
    wins = c.agg(F.sum(F.col("pos") * (F.col("N") - F.col("fp") + F.col("neg") / 2)).alias("w"), F.max("P").alias("P"), F.max("N").alias("N"))
    return wins.select(F.try_divide("w", (F.col("P") * F.col("N")).cast("double")).alias("auc"))


def density(df: DataFrame, label: str = "label", score: str = "score", bins: int = 50) -> DataFrame:
    """label, bin, from and density of scores from 0 to 1: histograms of equal width whose areas are 1."""
    at = F.least(F.greatest(F.floor(F.col(score) * bins), F.lit(0)), F.lit(bins - 1)).cast("int")
    counts = df.groupBy(F.col(label).alias("label"), at.alias("bin")).agg(F.count("*").alias("n"))  # at most bins rows for each label
    total = counts.groupBy("label").agg(F.sum("n").alias("total"))
    return counts.join(F.broadcast(total), "label").select("label", "bin", (F.col("bin") / bins).alias("from"), (F.col("n") * bins / F.col("total")).alias("density"))


def logloss(df: DataFrame, label: str = "label", score: str = "score", eps: float = 1e-15) -> DataFrame:
    p = F.least(F.greatest(F.col(score), F.lit(eps)), F.lit(1 - eps))
    return df.agg((-F.avg(F.col(label) * F.log(p) + (1 - F.col(label)) * F.log(1 - p))).alias("logloss"))


def r2(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """1 - residual over total sum of squares, from one aggregation."""
    y, s = F.col(label).cast("double"), F.col(score)
    t = df.agg(F.sum((y - s) * (y - s)).alias("res"), (F.var_pop(y) * F.count(y)).alias("tot"))
    return t.select((1 - F.try_divide("res", "tot")).alias("r2"))


def confusion(df: DataFrame, threshold: float, label: str = "label", score: str = "score") -> DataFrame:
    """tp, fp, fn, tn, precision, recall, f1 and accuracy at a threshold."""
    hit = F.col(score) >= threshold
    n = lambda c: F.count_if(c)
    t = df.agg(n(hit & (F.col(label) == 1)).alias("tp"), n(hit & (F.col(label) == 0)).alias("fp"), n(~hit & (F.col(label) == 1)).alias("fn"), n(~hit & (F.col(label) == 0)).alias("tn"))
    d = lambda a, b: F.try_divide(a.cast("double"), b.cast("double"))
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return t.select("tp", "fp", "fn", "tn", d(tp, tp + fp).alias("precision"), d(tp, tp + fn).alias("recall"), d(2 * tp, 2 * tp + fp + fn).alias("f1"), d(tp + tn, tp + fp + fn + tn).alias("accuracy"))


def shares(df: DataFrame, column: str) -> DataFrame:
    """Value counts with their share of all rows, and a label of both."""
    c = df.groupBy(column).agg(F.count("*").alias("count"))
    total = c.agg(F.sum("count").alias("_n"))
    c = c.crossJoin(F.broadcast(total)).withColumn("percent", F.round(F.col("count") * 100.0 / F.col("_n"), 2)).drop("_n")
    return c.withColumn("label", F.concat(F.format_number("count", 0), F.lit(" ("), F.format_string("%.2f", "percent"), F.lit("%)")))


def _unpivoted(one_row: DataFrame, columns: list[str], value: str) -> DataFrame:
    return one_row.unpivot([], columns, "column_name", value)


def null_report(df: DataFrame) -> DataFrame:
    """Columns with nulls, and how many."""
    counts = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in df.columns])
    return _unpivoted(counts, df.columns, "nulls").where("nulls > 0")


def constant_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """Numeric columns whose standard deviation is 0."""
    sd = df.agg(*[F.stddev_samp(f"`{c}`").alias(c) for c in columns])
    return _unpivoted(sd, columns, "sd").where("sd = 0").select("column_name")


def drop_constant(df: DataFrame, columns: list[str]) -> DataFrame:
    """df without its constant columns; only their names are on the driver."""
    return df.drop(*[r["column_name"] for r in constant_columns(df, columns).collect()])


def best(df: DataFrame, value: str, by: str) -> Column:
    return F.max_by(value, by)


def kde(df: DataFrame, label: str = "label", score: str = "score", points: int = 101, bins: int = 1000) -> DataFrame:
    """label, at and density: a Gaussian kernel density of scores from 0 to 1 on a grid of points, for each label.

    Scores are counted at the nearest of the bins' marks, and the counts are folded with the kernel, so what follows the
    one aggregation has the size of the grid. The bandwidth is the standard deviation times n^(-1/5), from aggregates; where
    it is 0 or unknown (one score, or equal ones) the bin's width stands in.
    """
    s = F.least(F.greatest(F.col(score), F.lit(0.0)), F.lit(1.0))
    by = df.where(F.col(score).isNotNull()).groupBy(F.col(label).alias("label"), F.round(s * bins).cast("int").alias("bin")).agg(F.count("*").alias("n"), F.sum(s).alias("s"), F.sum(s * s).alias("q"))
    n, mean = F.sum("n"), F.sum("s") / F.sum("n")
    spread = F.sqrt(F.greatest((F.sum("q") - n * mean * mean) / F.nullif(n - 1, F.lit(0)), F.lit(0.0)))
    h = spread * F.pow(n.cast("double"), -0.2)
    wide = by.groupBy("label").agg(n.alias("total"), F.when(h > 1e-9, h).otherwise(1.0 / bins).alias("h"))
    at = F.explode(F.transform(F.sequence(F.lit(0), F.lit(points - 1)), lambda i: i / F.lit(float(points - 1)))).alias("at")
    z = (F.col("at") - F.col("bin") / bins) / F.col("h")
    folded = by.join(F.broadcast(wide), "label").select("*", at)
    return folded.groupBy("label", "at").agg(F.sum(F.col("n") * F.exp(-0.5 * z * z) / (F.col("total") * F.col("h") * math.sqrt(2 * math.pi))).alias("density"))
