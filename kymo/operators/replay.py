"""Replay of the state machine over a grid of parameters, and the search grid itself.

A series is replayed for all parameters at once: every step of time is one
NumPy operation over the grid, so a grid of hundreds costs little more than one
parameter.  Series are bounded (a recording, a user's events) and spread over
tasks; only sums per parameter are shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kymo.functions.exprs import safe_div
from kymo.operators.state import ordered_series
from kymo.session import ship

#: Fixed values of the search space.
ALPHAS, MEDIANS, T_OFFS, K_ONS, K_OFFS, COOLDOWNS = (0.2, 0.4, 0.6), (1, 3), (0.20, 0.35, 0.50), (2, 3, 5), (1, 2, 3), (0.0, 2.0, 5.0)
STRATEGIES = ("final_state", "majority_state_after_warmup", "any_worn_after_warmup")
DEADLINES = (3, 4, 5, 6, 7, 8)
FIELDS = ("alpha", "median_k", "t_on", "t_off", "k_on", "k_off", "cooldown", "strategy")
_PREFERENCE = {"majority_state_after_warmup": 0, "final_state": 1, "any_worn_after_warmup": 2}


def on_thresholds(model_threshold: float) -> list[float]:
    """Candidates for the on threshold: a little above the model's own, and three fixed ones."""
    raw = [model_threshold + d for d in (0.02, 0.05, 0.10)] + [0.55, 0.70, 0.85]
    return sorted({round(min(0.95, max(0.05, t)), 10) for t in raw})


def search_grid(model_threshold: float = 0.5) -> list[dict]:
    """Every admissible combination: the on threshold above the off one, at least as many hits to turn on as off."""
    axes = product(ALPHAS, MEDIANS, on_thresholds(model_threshold), T_OFFS, K_ONS, K_OFFS, COOLDOWNS, STRATEGIES)
    points = (dict(zip(FIELDS, x, strict=True)) for x in axes)
    return [p for p in points if p["t_on"] > p["t_off"] and p["k_on"] >= p["k_off"]]


def within_budget(grid: list[dict], budget: int = 240) -> list[dict]:
    """At most ``budget`` points: the grid's ends and middle, the first of each strategy, then those least likely to give false alarms."""
    if not 0 < budget < len(grid):
        return list(grid)
    anchors = [0, len(grid) // 2, len(grid) - 1] + [next(i for i, p in enumerate(grid) if p["strategy"] == s) for s in STRATEGIES if any(p["strategy"] == s for p in grid)]

    def caution(i: int) -> tuple:
        p = grid[i]
        return (_PREFERENCE[p["strategy"]], -p["t_on"], -p["k_on"], p["k_off"], abs(p["alpha"] - 0.4), -p["median_k"], p["cooldown"], -p["t_off"])

    order = dict.fromkeys([*anchors, *sorted(range(len(grid)), key=caution)])
    return [grid[i] for i in list(order)[:budget]]


def causal_median(x: np.ndarray, k: int) -> np.ndarray:
    """Median of the last ``k`` values, of fewer at the start."""
    return np.array([np.median(x[max(0, i - k + 1) : i + 1]) for i in range(len(x))]) if k > 1 else x


def replay(probs: np.ndarray, quality: np.ndarray, grid: list[dict]) -> np.ndarray:
    """States of one series, ``(steps, points of the grid)``; a step takes one second."""
    column = {f: np.array([p[f] for p in grid]) for f in FIELDS[:-1]}
    medians = {k: causal_median(probs, int(k)) for k in np.unique(column["median_k"])}
    seen = np.stack([medians[k] for k in column["median_k"]], axis=1) if len(probs) else np.zeros((0, len(grid)))
    score = np.zeros(len(grid))
    state, on, off = (np.zeros(len(grid), dtype=np.int64) for _ in range(3))
    steps = np.full(len(grid), 999)
    wait = column["cooldown"].astype(np.int64)
    out = np.zeros(seen.shape, dtype=np.int64)
    for t, p in enumerate(seen):
        q = min(max(float(quality[t]), 0.0), 1.0)
        weight = column["alpha"] * q
        score = q * p if t == 0 else weight * p + (1 - weight) * score
        steps += 1
        idle = state == 0
        on = np.where(idle, np.where(score > column["t_on"], on + 1, np.maximum(on - 1, 0)), on)
        off = np.where(idle, off, np.where(score < column["t_off"], off + 1, np.maximum(off - 1, 0)))
        flips = (steps >= wait) & np.where(idle, on >= column["k_on"], off >= column["k_off"])
        state = np.where(flips, 1 - state, state)
        on, off, steps = (np.where(flips, 0, x) for x in (on, off, steps))
        out[t] = state
    return out


def outcomes(states: np.ndarray, target: int, labels: np.ndarray, grid: list[dict]) -> dict[str, np.ndarray]:
    """What a replayed series gives at every point of the grid."""
    n = len(states)
    worn = states.sum(axis=0)
    never = np.full(len(grid), n)
    first = np.where(worn > 0, states.argmax(axis=0), n) if n else never
    times = np.arange(n)[:, None]
    right = (states == target) & (times >= first[None, :])
    correct_at = np.where(right.any(axis=0), right.argmax(axis=0), -1) if n else never - n - 1
    strategy = np.array([STRATEGIES.index(p["strategy"]) for p in grid])
    votes = [states[-1] if n else worn, (2 * worn >= n) & (n > 0), worn > 0]
    pred = np.choose(strategy, [np.asarray(v).astype(np.int64) for v in votes])
    truth = labels[:, None] == 1
    out = {
        "pred": pred, "worn": worn, "first": np.where(first < n, first, -1), "correct_at": correct_at,
        "flips": (states[1:] != states[:-1]).sum(axis=0) if n else worn,
        "w_tp": ((states == 1) & truth).sum(axis=0), "w_fp": ((states == 1) & ~truth).sum(axis=0), "w_fn": ((states == 0) & truth).sum(axis=0), "w_tn": ((states == 0) & ~truth).sum(axis=0),
    }
    for d in DEADLINES:
        now = states[min(d, n) - 1] if n else worn
        out[f"at_{d}"] = ((first + 1 <= d) & (first < n) & (now == target)).astype(np.int64)
    return out


def replay_table(df: DataFrame, entity: str, order: list[str], prob: str, label: str, target: str, grid: list[dict], quality: str | None = None) -> DataFrame:
    """``entity, target, pid`` and the outcomes: one row for a series and a point of the grid."""
    ship(df.sparkSession)
    rows = df if quality else df.withColumn("_quality", F.lit(1.0))
    series = ordered_series(rows, [entity, target], order, prob, label, quality or "_quality").select(F.col(entity), F.col(target).cast("int").alias("target"), "series")
    names = [*outcomes(np.zeros((1, len(grid)), dtype=np.int64), 0, np.zeros(1), grid)]
    schema = f"{entity} {df.schema[entity].dataType.simpleString()}, target int, pid int, " + ", ".join(f"{n} long" for n in names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                points = batch.column("series")[i].values
                value = lambda c, points=points: points.field(c).to_numpy(zero_copy_only=False)
                target_ = batch.column("target")[i].as_py()
                found = outcomes(replay(value(prob).astype(float), value(quality or "_quality").astype(float), grid), target_, value(label), grid)
                own = pa.array([batch.column(entity)[i].as_py()] * len(grid), type=batch.column(entity).type)
                yield pa.RecordBatch.from_arrays([own, pa.array([target_] * len(grid), pa.int32()), pa.array(range(len(grid)), pa.int32()), *[pa.array(found[n].astype(np.int64)) for n in names]], names=[entity, "target", "pid", *names])

    return series.mapInArrow(run, schema)


def dataset_metrics(table: DataFrame) -> DataFrame:
    """Metrics per point of the grid; a latency that never comes about is null."""
    hit = lambda t, p: F.sum(F.when((F.col("target") == t) & (F.col("pred") == p), 1).otherwise(0))
    negative, latency = F.col("target") == 0, F.when(F.col("first") >= 0, F.col("first").cast("double"))
    agg = table.groupBy("pid").agg(
        hit(1, 1).alias("tp"), hit(0, 1).alias("fp"), hit(1, 0).alias("fn"), hit(0, 0).alias("tn"), *[F.sum(c).alias(c) for c in ("w_tp", "w_fp", "w_fn", "w_tn", "flips")],
        F.avg(latency).alias("first_output_mean_sec"), F.percentile(latency, F.lit(0.95)).alias("first_output_p95_sec"),
        F.percentile(F.when((F.col("target") == 1) & (F.col("pred") == 1), latency), F.lit(0.95)).alias("first_worn_p95_sec"),
        F.avg(F.when(F.col("correct_at") >= 0, F.col("correct_at") + 1.0)).alias("time_to_correct_sec"),
        *[F.avg(F.col(f"at_{d}").cast("double")).alias(f"accuracy_at_{d}s") for d in DEADLINES],
        F.avg(F.when(negative, (F.col("worn") > 0).cast("double"))).alias("false_worn_event_rate"), F.avg(F.when(negative, F.col("worn").cast("double"))).alias("false_worn_duration_sec"),
    )
    c = F.col
    return agg.select(
        "pid", "flips",
        safe_div(c("tp") + c("tn"), c("tp") + c("fp") + c("fn") + c("tn")).alias("sample_accuracy"), safe_div(c("tp"), c("tp") + c("fn")).alias("sample_recall"), safe_div(c("fp"), c("fp") + c("tn")).alias("sample_fp_rate"),
        safe_div(c("w_tp") + c("w_tn"), c("w_tp") + c("w_fp") + c("w_fn") + c("w_tn")).alias("window_accuracy"), safe_div(c("w_fp"), c("w_fp") + c("w_tn")).alias("window_fp_rate"),
        "first_output_mean_sec", "first_output_p95_sec", "first_worn_p95_sec", "time_to_correct_sec", *[f"accuracy_at_{d}s" for d in DEADLINES],
        F.coalesce("false_worn_event_rate", F.lit(0.0)).alias("false_worn_event_rate"), F.coalesce("false_worn_duration_sec", F.lit(0.0)).alias("false_worn_duration_sec"),
    )
