"""The on/off state machine as a fold over an ordered series.

Score: ``q * p`` first, then an exponential average of ``p`` with weight
``alpha * q``, where ``q`` is the quality, clipped to 0..1.  The state
turns on after ``k_on`` scores above ``t_on`` and off after ``k_off`` below
``t_off``; counters leak by one instead of resetting, and no flip happens
within the cooldown after the last.  One fold per entity, on arrays of bounded
series (a recording, a user's events), never over the whole table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_SEED = "struct<score:double,state:int,on:int,off:int,steps:int,trace:array<int>,scores:array<double>>"


def ordered_series(df: DataFrame, keys: list[str], order: list[str], *values: str) -> DataFrame:
    """``keys`` and ``series``: the rows as an ordered array of structs."""
    return df.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(*order, *values))).alias("series"))


def run_machine(series: Column, prob: str, t_on: Column, t_off: Column, k_on: Column, k_off: Column, cooldown: Column, alpha: Column, quality: str | None = None) -> Column:
    """``struct<score, state, ..., trace, scores>`` after the series."""

    def step(acc: Column, x: Column) -> Column:
        q = F.least(F.greatest(x[quality], F.lit(0.0)), F.lit(1.0)) if quality else F.lit(1.0)
        weight = alpha * q
        score = F.when(acc["score"].isNull(), q * x[prob]).otherwise(weight * x[prob] + (1 - weight) * acc["score"])
        return _bind(score, lambda s: _next(acc, s))

    def _next(acc: Column, s: Column) -> Column:
        ready = acc["steps"] + 1 >= cooldown
        on = F.when(acc["state"] == 0, F.when(s > t_on, acc["on"] + 1).otherwise(F.greatest(acc["on"] - 1, F.lit(0)))).otherwise(F.lit(0))
        off = F.when(acc["state"] == 1, F.when(s < t_off, acc["off"] + 1).otherwise(F.greatest(acc["off"] - 1, F.lit(0)))).otherwise(F.lit(0))
        turns_on, turns_off = (acc["state"] == 0) & ready & (on >= k_on), (acc["state"] == 1) & ready & (off >= k_off)
        state = F.when(turns_on, 1).when(turns_off, 0).otherwise(acc["state"])
        flips = turns_on | turns_off
        return F.struct(
            s.alias("score"),
            state.alias("state"),
            F.when(flips, 0).otherwise(on).alias("on"),
            F.when(flips, 0).otherwise(off).alias("off"),
            F.when(flips, 0).otherwise(acc["steps"] + 1).alias("steps"),
            F.array_append(acc["trace"], state).alias("trace"),
            F.array_append(acc["scores"], s).alias("scores"),
        )

    seed = F.struct(F.lit(None).cast("double"), F.lit(0), F.lit(0), F.lit(0), F.lit(999), F.array().cast("array<int>"), F.array().cast("array<double>")).cast(_SEED)
    return F.aggregate(series, seed, step)


def _bind(value: Column, then) -> Column:
    """SQL has no let: a one-element array carries a value that is used more than once."""
    return F.element_at(F.transform(F.array(value), then), 1)


def default_thresholds(model_threshold: Column, t_on: float = 0.75, t_off: float = 0.35) -> tuple[Column, Column]:
    """On and off thresholds that follow the model's own where it lies below the default."""
    on = F.when(model_threshold < t_on, F.least(F.lit(0.95), F.greatest(F.lit(0.5), model_threshold + 0.05))).otherwise(F.lit(t_on))
    return on, F.least(on - 0.05, F.greatest(F.lit(0.10), model_threshold - 0.20))
