"""Ordered-series operators: windows, filters, repairs and run lengths.

Every operator takes the entity, the order (with tie-breakers) and the value
by column name; one shuffle on the entity serves all frames of a query.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kymo.functions.exprs import finite


def numbered(df: DataFrame, entity: str, order: list[str], out: str = "i") -> DataFrame:
    w = Window.partitionBy(entity).orderBy(*order)
    return df.withColumn(out, (F.row_number().over(w) - 1).cast("long"))


def sliding_windows(df: DataFrame, win: int, stride: int | Column, i: str = "i") -> DataFrame:
    """Rows exploded over the windows that hold them; incomplete windows are left to ``full_windows``."""
    s = F.lit(stride) if isinstance(stride, int) else stride
    first = F.greatest(F.lit(0).cast("long"), F.ceil((F.col(i) - win + 1) / s))
    return df.withColumn("wid", F.explode(F.when(first <= F.floor(F.col(i) / s), F.sequence(first, F.floor(F.col(i) / s)))))


def full_windows(df: DataFrame, keys: list[str], win: int, *aggs: Column) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), *aggs).where(F.col("n") == win)


def frame(entity: str, order: list[str], lo: int, hi: int):
    return Window.partitionBy(entity).orderBy(*order).rowsBetween(lo, hi)


def rolling_median(v: Column, entity: str, order: list[str], lo: int, hi: int) -> Column:
    return F.percentile(v, F.lit(0.5)).over(frame(entity, order, lo, hi))


def same_mean(v: Column, entity: str, order: list[str], k: int) -> Column:
    """Centred mean with zero padding: the divisor is ``k`` at the edges as well."""
    lo, hi = (-(k - 1) // 2, (k - 1) // 2) if k % 2 else (-k // 2, k // 2 - 1)
    return F.sum(v).over(frame(entity, order, lo, hi)) / F.lit(float(k))


def median5_zero_padded(v: Column, entity: str, order: list[str]) -> Column:
    w = Window.partitionBy(entity).orderBy(*order)
    near = [F.lag(v, 2, 0.0).over(w), F.lag(v, 1, 0.0).over(w), v, F.lead(v, 1, 0.0).over(w), F.lead(v, 2, 0.0).over(w)]
    return F.array_sort(F.array(*near))[2]


def fill_with_median(df: DataFrame, entity: str, value: str, out: str) -> DataFrame:
    """Null, NaN and infinities become the entity's median of finite values, or 0."""
    v = finite(F.col(value))
    med = F.percentile(v, F.lit(0.5)).over(Window.partitionBy(entity))
    return df.withColumn(out, F.coalesce(v, med, F.lit(0.0)))


def repair_spikes(df: DataFrame, entity: str, order: list[str], value: str, factor: float = 6.0) -> DataFrame:
    """Isolated points further from both neighbours than ``factor`` MADs of the differences become the neighbours' mean."""
    w, whole = Window.partitionBy(entity).orderBy(*order), Window.partitionBy(entity)
    v = F.col(value)
    d = df.withColumn("_d", v - F.lag(v).over(w))
    d = d.withColumn("_m", F.percentile("_d", F.lit(0.5)).over(whole))
    d = d.withColumn("_mad", F.percentile(F.abs(F.col("_d") - F.col("_m")), F.lit(0.5)).over(whole))
    before, after = F.lag(v).over(w), F.lead(v).over(w)
    limit = factor * F.greatest("_mad", F.lit(1e-12))
    spike = (F.abs(v - before) > limit) & (F.abs(v - after) > limit)
    return d.withColumn("repaired", F.when(F.coalesce(spike, F.lit(False)), (before + after) / 2).otherwise(v)).withColumn("is_spike", F.coalesce(spike, F.lit(False)).cast("int")).drop("_d", "_m", "_mad")


def sequential_repair(values: Column, limit: Column) -> Column:
    """Left-to-right step repair of an array: a jump beyond ``limit`` from the repaired predecessor is cancelled."""

    def step(acc: Column, v: Column) -> Column:
        jump = v - acc["last"]
        kept = F.when(acc["last"].isNull() | (F.abs(jump) <= limit), v).otherwise(acc["last"])
        return F.struct(kept.alias("last"), F.array_append(acc["out"], kept).alias("out"))

    seed = F.struct(F.lit(None).cast("double").alias("last"), F.array().cast("array<double>").alias("out"))
    return F.aggregate(values, seed, step)["out"]


def runs(df: DataFrame, entity: str, order: list[str], hit: Column) -> DataFrame:
    """Gaps and islands: one row per run of true ``hit`` with its length."""
    w = Window.partitionBy(entity).orderBy(*order)
    d = df.withColumn("_hit", hit.cast("int")).withColumn("_n", F.row_number().over(w))
    d = d.withColumn("_g", F.col("_n") - F.row_number().over(Window.partitionBy(entity, "_hit").orderBy(*order)))
    return d.where("_hit = 1").groupBy(entity, "_g").agg(F.count(F.lit(1)).alias("run")).drop("_g")


def segment_id(i: Column, n: Column, k: int) -> Column:
    """Equal segments of ``floor(n / k)`` points; the last takes the remainder."""
    return F.least(F.floor(i / F.floor(n / k)), F.lit(k - 1))


def lag_products(df: DataFrame, key: str, pos: str, x: str, y: str, lags: list[int]) -> DataFrame:
    """Sums of ``x[i] * y[i + lag]`` for a stated set of lags: rows are copied per lag and joined on equality."""
    a = df.select(key, F.col(pos).alias("p"), F.col(x).alias("xv"), F.explode(F.array(*map(F.lit, lags))).alias("lag"))
    b = df.select(F.col(key).alias("k2"), F.col(pos).alias("q"), F.col(y).alias("yv"))
    j = a.join(b, (F.col(key) == F.col("k2")) & (F.col("q") == F.col("p") + F.col("lag")))
    return j.groupBy(key, "lag").agg(F.sum(F.col("xv") * F.col("yv")).alias("s"), F.sum(F.col("xv") * F.col("xv")).alias("sx"), F.sum(F.col("yv") * F.col("yv")).alias("sy"), F.count(F.lit(1)).alias("n"))
