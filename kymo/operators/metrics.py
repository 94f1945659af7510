"""Grouped statistics: AUC, drift, proxies, strata and selection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kymo.functions.exprs import confusion, rates, safe_div, threshold_grid


def long_features(df: DataFrame, keep: list[str], features: list[str]) -> DataFrame:
    """One row per (row, feature): the unpivot that every per-feature statistic groups by."""
    return df.select(*keep, *[F.col(f).cast("double").alias(f) for f in features]).unpivot(keep, features, "feature", "value")


def rank_auc(df: DataFrame, keys: list[str], value: str, label: str, weight: str | None = None) -> DataFrame:
    """Mann-Whitney AUC per group with tied values averaged, from counts per distinct value.

    Counting first keeps a hot group out of one sort: only distinct values are
    ranked, and the counts combine on the map side.  ``weight`` holds the rows
    that a row stands for.
    """
    rows = F.lit(1).cast("long") if weight is None else F.col(weight)
    per = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.sum(F.col(label).cast("long") * rows).alias("pos"), F.sum(rows).alias("all"))
    w = Window.partitionBy(*keys).orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    ranked = per.withColumn("below", F.coalesce(F.sum("all").over(w), F.lit(0)))
    rank = F.col("below") + (F.col("all") + 1) / F.lit(2.0)
    agg = ranked.groupBy(*keys).agg(F.sum(rank * F.col("pos")).alias("r"), F.sum("pos").alias("n1"), F.sum(F.col("all") - F.col("pos")).alias("n0"))
    auc = F.when((F.col("n1") > 0) & (F.col("n0") > 0), F.try_divide(F.col("r") - F.col("n1") * (F.col("n1") + 1) / F.lit(2.0), F.col("n1") * F.col("n0")))
    return agg.select(*keys, "n1", "n0", auc.alias("auc"))


def ks_statistic(df: DataFrame, key: str, value: str, side: Column) -> DataFrame:
    """Two-sample Kolmogorov-Smirnov statistic per ``key``; ``side`` is true for the first sample."""
    per = df.groupBy(key, value).agg(F.count(F.when(side, 1)).alias("a"), F.count(F.when(~side, 1)).alias("b"))
    upto = Window.partitionBy(key).orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(key)
    d = per.withColumn("d", F.abs(F.try_divide(F.sum("a").over(upto), F.sum("a").over(whole)) - F.try_divide(F.sum("b").over(upto), F.sum("b").over(whole))))
    return d.groupBy(key).agg(F.max("d").alias("ks"), F.sum("a").alias("n_a"), F.sum("b").alias("n_b"))


def psi(df: DataFrame, key: str, value: str, side: Column, n_bins: int = 10) -> DataFrame:
    """Population stability index over bins of the first sample's percentiles; shares are floored at 1e-6."""
    q = df.where(side).groupBy(F.col(key).alias("k")).agg(F.percentile(value, F.array(*[F.lit(j / n_bins) for j in range(1, n_bins)])).alias("q"))
    binned = df.join(q, F.col(key) == F.col("k")).withColumn("bin", F.aggregate("q", F.lit(0), lambda a, z: a + F.when(z <= F.col(value), 1).otherwise(0)))
    counts = binned.groupBy(key, "bin").agg(F.count(F.when(side, 1)).alias("a"), F.count(F.when(~side, 1)).alias("b"))
    grid = counts.select(key).distinct().withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(n_bins - 1))))
    full = grid.join(counts, [key, "bin"], "left").fillna(0, ["a", "b"])
    whole = Window.partitionBy(key)
    p = F.greatest(safe_div(F.col("a"), F.sum("a").over(whole)), F.lit(1e-6))
    r = F.greatest(safe_div(F.col("b"), F.sum("b").over(whole)), F.lit(1e-6))
    return full.withColumn("t", (r - p) * F.ln(r / p)).groupBy(key).agg(F.sum("t").alias("psi"))


def strata(df: DataFrame, dimensions: list[str], target: str, pred: str, sample: str, min_support: int) -> DataFrame:
    """Confusion metrics for every value of every dimension, with distinct-sample support."""
    pairs = F.array(*[F.struct(F.lit(d).alias("dimension"), F.col(d).cast("string").alias("stratum")) for d in dimensions])
    long = df.select(target, pred, sample, F.explode(pairs).alias("s")).select(target, pred, sample, "s.dimension", "s.stratum")
    agg = long.groupBy("dimension", "stratum").agg(*confusion(F.col(target), F.col(pred)), F.countDistinct(sample).alias("n_samples"))
    return agg.select("*", *rates(), (F.col("n_samples") < min_support).cast("int").alias("low_support"))


def top_with_caps(df: DataFrame, group: str, order: list[Column], cap: Column, total: int) -> DataFrame:
    """At most ``cap`` rows of a group, then the best ``total`` of all."""
    w = Window.partitionBy(group).orderBy(*order)
    capped = df.withColumn("group_rank", F.row_number().over(w)).where(F.col("group_rank") <= cap)
    return capped.orderBy(*order).limit(total)


def stratified_sample(df: DataFrame, strata_columns: list[str], key: Column, per: int) -> DataFrame:
    """``per`` rows of each stratum in hash order: the same rows on every run and partitioning."""
    w = Window.partitionBy(*strata_columns).orderBy(key)
    return df.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= per).drop("_r")


def threshold_curve(df: DataFrame, prob: str, label: str) -> DataFrame:
    """``k, threshold`` and the exact rates of all 181 thresholds, from one pass: counts per cell, then suffix sums over 181 rows."""
    spark = df.sparkSession
    grid = threshold_grid(spark)
    cuts = [r["threshold"] for r in grid.orderBy("k").collect()]  # 181 constants
    at = F.aggregate(F.array(*map(F.lit, cuts)), F.lit(-1), lambda a, t: a + F.when(t <= F.col(prob), 1).otherwise(0))
    cells = df.groupBy(at.cast("long").alias("c")).agg(F.sum(label).alias("p"), F.sum(1 - F.col(label)).alias("n"))
    every = spark.range(-1, 181).select(F.col("id").alias("c")).join(cells, "c", "left").fillna(0)
    up, whole = Window.orderBy("c").rowsBetween(0, Window.unboundedFollowing), Window.partitionBy()
    x = every.select("c", F.sum("p").over(up).alias("tp"), F.sum("n").over(up).alias("fp"), F.sum("p").over(whole).alias("P"), F.sum("n").over(whole).alias("N")).where("c >= 0")
    tp, fp, tn, fn = F.col("tp"), F.col("fp"), F.col("N") - F.col("fp"), F.col("P") - F.col("tp")
    rates_ = x.select(F.col("c").alias("k"), safe_div(tp + tn, tp + fp + tn + fn).alias("accuracy"), safe_div(tp, tp + fp).alias("precision"), safe_div(tp, tp + fn).alias("recall"), safe_div(2 * tp, 2 * tp + fp + fn).alias("f1"), safe_div(fp, fp + tn).alias("fpr"))
    return grid.join(rates_, "k")
