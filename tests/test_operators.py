"""Operators against literal Python, and the same result whatever the partitioning."""

import math
import random

import pytest
from pyspark.sql import functions as F

from kymo import session
from kymo.functions import exprs
from kymo.operators import metrics, series, state
from kymo.plans import registry


def literal_machine(ps, qs, t_on, t_off, k_on, k_off, cooldown, alpha):
    score, st, on, off, steps, out = None, 0, 0, 0, 999, []
    for p, q in zip(ps, qs):
        q = min(max(q, 0.0), 1.0)
        score = q * p if score is None else alpha * q * p + (1 - alpha * q) * score
        steps += 1
        if st == 0:
            on = on + 1 if score > t_on else max(0, on - 1)
            if on >= k_on and steps >= cooldown:
                st, on, off, steps = 1, 0, 0, 0
        else:
            off = off + 1 if score < t_off else max(0, off - 1)
            if off >= k_off and steps >= cooldown:
                st, on, off, steps = 0, 0, 0, 0
        out.append(st)
    return out


def test_state_machine_equals_literal_loop_with_quality(spark):
    rnd = random.Random(3)
    rows = [(e, i, rnd.random(), rnd.choice([0.2, 0.7, 1.0, 1.5])) for e in range(12) for i in range(60)]
    df = spark.createDataFrame(rows, "e int, i int, p double, q double").repartition(7)
    lit = F.lit
    s = state.ordered_series(df, ["e"], ["i"], "p", "q").withColumn("m", state.run_machine(F.col("series"), "p", lit(0.5), lit(0.4), lit(2), lit(2), lit(4), lit(0.5), "q"))
    for r in s.select("e", "m.trace").collect():
        own = [x for x in rows if x[0] == r["e"]]
        assert r["trace"] == literal_machine([x[2] for x in own], [x[3] for x in own], 0.5, 0.4, 2, 2, 4, 0.5)


@pytest.mark.parametrize(("n", "win", "stride", "expect"), [(3, 5, 1, 0), (5, 5, 1, 1), (9, 5, 5, 1), (10, 5, 5, 2), (20, 5, 8, 2)])
def test_window_counts(spark, n, win, stride, expect):
    df = spark.range(n).select(F.lit(1).alias("e"), F.col("id").alias("i"))
    assert series.full_windows(series.sliding_windows(df, win, stride), ["e", "wid"], win).count() == expect


def test_constant_series_has_no_correlation_and_no_error(spark):
    df = spark.range(20).select(F.lit(1.0).alias("x"), F.col("id").cast("double").alias("y"))
    assert df.agg(exprs.guarded_corr(F.col("x"), F.col("y")).alias("r")).first()["r"] == 0.0


def test_null_nan_and_infinity_take_the_median(spark):
    rows = [(1, 0, 1.0), (1, 1, float("nan")), (1, 2, float("inf")), (1, 3, None), (1, 4, 3.0), (2, 0, None)]
    out = {(r["e"], r["i"]): r["f"] for r in series.fill_with_median(spark.createDataFrame(rows, "e int, i int, v double"), "e", "v", "f").collect()}
    assert out == {(1, 0): 1.0, (1, 1): 2.0, (1, 2): 2.0, (1, 3): 2.0, (1, 4): 3.0, (2, 0): 0.0}


def test_guarded_ratio_keeps_the_sign(spark):
    df = spark.createDataFrame([(1.0, 1e-9), (1.0, -1e-9), (1.0, 0.0), (1.0, 4.0)], "a double, b double")
    got = [r["r"] for r in df.select(exprs.guarded_ratio(F.col("a"), F.col("b"), F.lit(0.5)).alias("r")).collect()]
    assert got == [2.0, -2.0, 2.0, 0.25]


def test_auc_of_single_class_is_null_and_ties_average(spark):
    df = spark.createDataFrame([("a", 1.0, 1), ("a", 1.0, 0), ("b", 1.0, 1), ("b", 2.0, 1)], "k string, v double, y int")
    assert {r["k"]: r["auc"] for r in metrics.rank_auc(df, ["k"], "v", "y").collect()} == {"a": 0.5, "b": None}


def test_results_do_not_depend_on_partitions(spark):
    df = spark.range(400).select((F.col("id") % 5).alias("k"), (F.col("id") % 17).cast("double").alias("v"), (F.col("id") % 3 == 0).cast("int").alias("y"))
    seen = [sorted((r["k"], r["auc"]) for r in metrics.rank_auc(df.repartition(n), ["k"], "v", "y").collect()) for n in (1, 4, 16)]
    assert seen[0] == seen[1] == seen[2]


def test_golden_values_that_differ_are_told(spark, sf_dir, monkeypatch):
    kept = session.cut
    monkeypatch.setattr(session, "cut", lambda df, tag: kept(df.withColumn(df.columns[-1], F.col(df.columns[-1]) + 0.1 * (F.col("wid") % 2)), tag))
    rows = registry.QUERIES["golden_tolerance_join"](spark, sf_dir).collect()
    assert {r["same"] for r in rows} == {0, 1} and all(r["same"] == 1 - r["wid"] % 2 for r in rows)


def test_threshold_grid_is_exact(spark):
    t = [r["threshold"] for r in exprs.threshold_grid(spark).orderBy("k").collect()]
    assert len(t) == 181 and t[0] == 0.05 and t[-1] == 0.95 and all(math.isclose(b - a, 0.005, rel_tol=1e-9) for a, b in zip(t, t[1:]))
