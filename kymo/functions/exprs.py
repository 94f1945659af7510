"""Column helpers: guards, ratios, bins, scores and hashes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_finite(x: Column) -> Column:
    return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))


def finite(x: Column) -> Column:
    """Null for null, NaN and infinities."""
    return F.when(is_finite(x), x)


def safe_div(num: Column, den: Column, default: float = 0.0) -> Column:
    return F.coalesce(F.try_divide(num.cast("double"), den.cast("double")), F.lit(default))


def guarded_ratio(num: Column, den: Column, floor: Column) -> Column:
    """Ratio whose denominator keeps its sign and at least ``floor`` of magnitude (zero counts as positive)."""
    return num / F.when(F.abs(den) >= floor, den).otherwise(F.when(den < 0, -floor).otherwise(floor))


def guarded_corr(x: Column, y: Column, least: int = 8, floor: float = 1e-12) -> Column:
    """Pearson correlation aggregate; 0 for fewer than ``least`` pairs or a side without spread."""
    both = x.isNotNull() & y.isNotNull()
    a, b = F.when(both, x), F.when(both, y)
    ok = (F.count(a) >= least) & (F.stddev_pop(a) > floor) & (F.stddev_pop(b) > floor)
    cov = F.covar_pop(a, b)
    return F.when(ok, F.try_divide(cov, F.stddev_pop(a) * F.stddev_pop(b))).otherwise(F.lit(0.0))


def bins(x: Column, edges: list[float], labels: list[str], missing: str = "missing") -> Column:
    """``labels[k]`` for the first ``x < edges[k]``, the last label beyond; null or NaN is ``missing``."""
    out = F.when(x.isNull() | F.isnan(x), F.lit(missing))
    for edge, label in zip(edges, labels[:-1], strict=True):
        out = out.when(x < edge, F.lit(label))
    return out.otherwise(F.lit(labels[-1]))


def error_type(target: Column, pred: Column) -> Column:
    return F.when((target == 1) & (pred == 1), "TP").when((target == 0) & (pred == 1), "FP").when((target == 1) & (pred == 0), "FN").otherwise("TN")


def confusion(target: Column, pred: Column) -> list[Column]:
    """Aggregates tp, fp, tn, fn."""
    kind = error_type(target, pred)
    return [F.count(F.when(kind == k.upper(), 1)).alias(k) for k in ("tp", "fp", "tn", "fn")]


def rates() -> list[Column]:
    """Accuracy, precision, recall, f1, fpr and fnr from tp, fp, tn, fn; 0 for an empty denominator."""
    tp, fp, tn, fn = (F.col(c) for c in ("tp", "fp", "tn", "fn"))
    return [
        F.round(safe_div(tp + tn, tp + fp + tn + fn), 6).alias("accuracy"),
        F.round(safe_div(tp, tp + fp), 6).alias("precision"),
        F.round(safe_div(tp, tp + fn), 6).alias("recall"),
        F.round(safe_div(2 * tp, 2 * tp + fp + fn), 6).alias("f1"),
        F.round(safe_div(fp, fp + tn), 6).alias("fpr"),
        F.round(safe_div(fn, fn + tp), 6).alias("fnr"),
    ]


def quality_soft(violation: Column, floor: float = 0.5) -> Column:
    return F.greatest(F.lit(floor), 1 - (1 - floor) * F.least(F.greatest(violation, F.lit(0.0)), F.lit(1.0)))


def threshold_grid(spark):
    """181 thresholds from 0.05 to 0.95, equal to the last bit to an evenly spaced grid with exact ends."""
    i = F.col("id")
    t = F.when(i == 180, F.lit(0.95)).otherwise(i * F.lit((0.95 - 0.05) / 180) + F.lit(0.05))
    return spark.range(181).select(i.alias("k"), t.alias("threshold"))


def row_fingerprint(*columns: str) -> Column:
    """SHA-256 of the canonical JSON of the columns in name order."""
    return F.sha2(F.to_json(F.struct(*sorted(columns))), 256)


def safe_name(x: Column) -> Column:
    return F.regexp_replace(x, r"[^A-Za-z0-9_.-]+", "_")


def mult_hash(x: Column, modulus: int = 2**32) -> Column:
    """Multiplicative hash in plain integer arithmetic, reproducible in any SQL."""
    return (x.cast("bigint") * F.lit(2654435761)) % F.lit(modulus)


def first_below(x: Column, edges: list[tuple[float, str]], last: str, missing: str) -> Column:
    """The label of the first edge above ``x``; ``last`` beyond all, ``missing`` for null, NaN and infinities."""
    out = F.when(~is_finite(x), F.lit(missing))
    for edge, label in edges:
        out = out.when(x < edge, F.lit(label))
    return out.otherwise(F.lit(last))


def ood_bin(x: Column) -> Column:
    """Shares of outliers: none, some, many."""
    return F.when(~is_finite(x), "ood=missing").when(x <= 0, "ood=0").when(x < 0.3, "ood=0-0.3").otherwise("ood>=0.3")


#: The bins of reports.  A null count or mean probability is 0.
REPORT_BINS = {
    "n_windows": lambda x: F.when(F.coalesce(x, F.lit(0)) == 0, "nwin=0").when(x <= 3, "nwin=1-3").when(x <= 10, "nwin=4-10").otherwise("nwin>10"),
    "mean_prob": lambda x: first_below(F.coalesce(x, F.lit(0.0)), [(0.3, "mean_prob<0.3"), (0.6, "mean_prob=0.3-0.6")], "mean_prob>=0.6", "mean_prob>=0.6"),
    "window_prob": lambda x: first_below(x, [(0.2, "prob<0.2"), (0.5, "prob=0.2-0.5"), (0.8, "prob=0.5-0.8")], "prob>=0.8", "prob>=0.8"),
    "start": lambda x: first_below(x, [(6.0, "start<6s"), (15.0, "start=6-15s")], "start>=15s", "start>=15s"),
    "ood": ood_bin,
    "quality": lambda x: first_below(x, [(1.0, "quality_meta<1"), (10.0, "quality_meta=1-10")], "quality_meta>=10", "quality=missing"),
    "green_support": lambda x: first_below(x, [(2.0 / 3.0, "<2of3"), (1.0, "2of3")], "3of3", "missing"),
    "green_corr": lambda x: first_below(x, [(0.50, "low_corr"), (0.85, "mid_corr")], "high_corr", "missing"),
    "green_gap": lambda x: F.when(~is_finite(x), "missing").when(x > 0.60, "large_gap").when(x > 0.25, "mid_gap").otherwise("low_gap"),
    "green_stability": lambda x: first_below(x, [(0.35, "low_stability"), (0.75, "mid_stability")], "high_stability", "missing"),
    "green_top2_ratio": lambda x: F.when(is_finite(x) & (x > 0.90), "single_dominant").otherwise("balanced_top2"),
}

#: Names of the infrared channel.
INFRARED_PREFIXES = ("IR_", "IRX_", "GREEN_IR_", "IR_AMB_", "IR_over_", "log_IR_", "corr_IR_", "ACC_IR_")
INFRARED_NAMES = ("corr_Ambient_IR",)


def without_infrared(names: list[str]) -> list[str]:
    """The names that do not come from the infrared channel, in their order."""
    return [n for n in names if n not in INFRARED_NAMES and not n.startswith(INFRARED_PREFIXES)]


def aligned_slice(values: Column, start: Column, length: Column, ratio: float) -> Column:
    """The part of an array under a window of another one whose rate is ``1 / ratio`` times its own; null if it starts beyond the end."""
    lo = (start * F.lit(ratio)).cast("int")
    return F.when(lo < F.size(values), F.slice(values, lo + 1, (length * F.lit(ratio)).cast("int")))
