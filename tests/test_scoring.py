"""The search grid and the replay kernel against the literal machine."""

import random

import numpy as np
from pyspark.sql import functions as F

from kymo.functions import exprs
from kymo.operators import replay
from tests.test_operators import literal_machine


def test_grid_and_budget():
    grid = replay.search_grid(0.5)
    assert len(grid) == 6480 and all(p["t_on"] > p["t_off"] and p["k_on"] >= p["k_off"] for p in grid)
    some = replay.within_budget(grid, 240)
    assert len(some) == 240 and grid[0] in some and grid[3240] in some and grid[-1] in some
    assert replay.within_budget(grid, 0) == grid == replay.within_budget(grid, 10_000)


def test_replay_equals_the_literal_machine():
    rnd = random.Random(8)
    grid = [p for p in replay.within_budget(replay.search_grid(0.5), 60) if p["median_k"] == 1]
    probs, quality = [rnd.random() for _ in range(80)], [rnd.choice([0.3, 1.0, 1.4]) for _ in range(80)]
    states = replay.replay(np.array(probs), np.array(quality), grid)
    for k, p in enumerate(grid):
        assert states[:, k].tolist() == literal_machine(probs, quality, p["t_on"], p["t_off"], p["k_on"], p["k_off"], p["cooldown"], p["alpha"])


def test_bins_of_missing_values(spark):
    df = spark.createDataFrame([(None,), (float("nan"),), (0.25,)], "x double")
    got = [r["b"] for r in df.select(exprs.REPORT_BINS["green_gap"](F.col("x")).alias("b")).collect()]
    assert got == ["missing", "missing", "low_gap"]


def test_infrared_names_go():
    assert exprs.without_infrared(["IR_x", "G_IR_x", "corr_Ambient_IR", "log_IR_a", "b"]) == ["G_IR_x", "b"]
