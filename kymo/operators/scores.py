"""Score formulas of rankings and searches, as columns.  The weights are fixed values of the contract."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RANKING = {"mean_separation": 0.45, "min_separation": 0.25, "fp_fit": 0.20, "deployment_fit": 0.10}
END_TO_END = {"sample_accuracy": 0.30, "sample_recall": 0.20, "window_accuracy": 0.15, "sample_fp_rate": -0.25, "false_worn_event_rate": -0.20, "latency_penalty": -0.10, "deploy_cost": -0.05}
#: The weights of ``postprocess`` that do not depend on the price of a false positive.
REPLAY = {"sample_accuracy": 1.00, "sample_recall": 0.60, "accuracy_at_8s": 0.75, "window_accuracy": 0.25, "false_worn_duration_sec": -0.10, "window_fp_rate": -0.30}
#: Costs below which a name may not fall, by what it holds.
COST_FLOORS = (("SampEn|Entropy", 3.5), ("FFT|DOM_FREQ|AUTO_CORR", 2.8))


def weighted(weights: dict[str, float]) -> Column:
    total = F.lit(0.0)
    for name, weight in weights.items():
        total = total + F.lit(weight) * F.col(name)
    return total


def clip01(x: Column) -> Column:
    return F.least(F.greatest(x, F.lit(0.0)), F.lit(1.0))


def deployment_fit(feature: Column, cost: Column, scale_dependent: Column) -> Column:
    """1 for a free feature that no scale moves; costs take up to 0.45 of it, dependence on scale 0.25."""
    for pattern, floor in COST_FLOORS:
        cost = F.when(feature.rlike(pattern), F.greatest(cost, F.lit(floor))).otherwise(cost)
    return clip01(1 - F.least(cost / 4.0, F.lit(1.0)) * 0.45 - F.when(scale_dependent, 0.25).otherwise(0.0))


def ranking() -> Column:
    return weighted(RANKING)


def blended(base: Column, fit: Column, weight: float = 0.25) -> Column:
    w = min(max(weight, 0.0), 1.0)
    return (1 - w) * base + w * fit


def model_search(accuracy: Column, fp_rate: Column, nodes: Column, max_nodes: int = 400, fp_cost: float = 2.0, size_cost: float = 0.1) -> Column:
    """Null for a model over ``max_nodes``, which no model is if that is 0."""
    if max_nodes <= 0:
        return accuracy - fp_cost * fp_rate
    return F.when(nodes <= max_nodes, accuracy - fp_cost * fp_rate - size_cost * nodes / float(max_nodes))


def postprocess(fp_cost: float = 1.5) -> Column:
    """Null where no output ever comes."""
    return weighted(REPLAY) - fp_cost * (F.col("sample_fp_rate") + F.col("false_worn_event_rate")) - 0.10 * F.col("first_output_p95_sec") / 8.0


def end_to_end(max_latency: float = 6.0) -> Column:
    """Needs the columns of ``END_TO_END`` but for the penalty, and ``first_worn_p95_sec``."""
    penalty = F.greatest(F.coalesce("first_worn_p95_sec", F.lit(max_latency)) / max(max_latency, 1e-6), F.lit(0.0))
    rest = {k: w for k, w in END_TO_END.items() if k != "latency_penalty"}
    return weighted(rest) + END_TO_END["latency_penalty"] * penalty


def satisfies(max_sample_fp: float = 0.02, max_event_rate: float = 0.02, max_latency: float = 3.0) -> Column:
    """The search's constraints: few false positives and events, soon enough, and right at eight seconds at least once."""
    soon = F.coalesce(F.col("first_worn_p95_sec") <= max_latency, F.lit(False))
    return (F.col("sample_fp_rate") <= max_sample_fp) & (F.col("false_worn_event_rate") <= max_event_rate) & soon & (F.col("accuracy_at_8s") > 0)


#: Objective -> the keys of a threshold in order of weight; equal ones go to the lowest threshold.
OBJECTIVES = {
    "accuracy": ("accuracy", "-fpr", "f1", "precision", "recall"),
    "precision": ("precision", "accuracy", "recall", "-fpr"),
    "recall": ("recall", "accuracy", "-fpr", "precision"),
    "f1": ("f1", "accuracy", "-fpr", "precision", "recall"),
    "fbeta": ("fbeta", "accuracy", "-fpr", "precision", "recall"),
    "precision_constrained": ("constrained", "accuracy", "-fpr", "precision", "recall"),
}


def threshold_choices(curve: DataFrame, beta: float = 0.5, min_precision: float = 0.95) -> DataFrame:
    """``objective, k, threshold, score``: the best of a table of thresholds (``k, threshold`` and the exact rates) for every objective."""
    p, r, b2 = F.col("precision"), F.col("recall"), beta * beta
    fbeta = F.when(b2 * p + r > 0, (1 + b2) * p * r / (b2 * p + r)).otherwise(0.0)
    x = curve.withColumn("fbeta", fbeta).withColumn("constrained", F.when(p >= min_precision, r).otherwise(p - 1.0))

    def key(names: tuple[str, ...]) -> Column:
        parts = [(-F.col(n[1:]) if n.startswith("-") else F.col(n)).alias(f"k{i}") for i, n in enumerate(names)]
        return F.struct(*parts, (-F.col("k")).alias("first"))

    best = [F.max_by(F.struct(F.lit(o).alias("objective"), "k", "threshold", F.col(names[0]).alias("score")), key(names)).alias(o) for o, names in OBJECTIVES.items()]
    one = x.agg(*best)
    return one.select(F.explode(F.array(*OBJECTIVES)).alias("x")).where("x IS NOT NULL").select("x.*")


def accept_retrained(reference_accuracy: Column, candidate_accuracy: Column, reference_fpr: Column, candidate_fpr: Column, tolerance: float = 1e-12) -> Column:
    """Whether a model retrained on hard negatives replaces the former one, with the reason."""
    worse, more = candidate_accuracy < reference_accuracy - tolerance, candidate_fpr > reference_fpr + tolerance
    reason = F.when(worse, "valid_accuracy_decreased").when(more, "valid_false_positive_rate_increased").otherwise("accuracy_not_lower_and_fpr_not_higher")
    return F.struct((~worse & ~more).alias("accepted"), reason.alias("reason"))
