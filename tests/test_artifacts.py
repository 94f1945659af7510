"""Artifacts written and read again, and the literal forms of swaps, strategies and contracts."""

import math

import pytest
from pyspark.sql import functions as F

from kymo.operators import subsets
from kymo.session import fresh_folder
from kymo.sources import artifacts


def test_json_is_replaced_and_the_latest_is_found(spark):
    folder = fresh_folder(spark, "json")
    assert artifacts.read_json(spark, f"{folder}/a.json") == {} == artifacts.read_json(spark, None)
    artifacts.write_json(spark, f"{folder}/a.json", {"x": math.nan, "y": "é"})
    artifacts.write_json(spark, f"{folder}/a.json", {"x": math.inf, "y": ["é", 2.5]})
    artifacts.write_json(spark, f"{folder}/b.json", {})
    assert artifacts.read_json(spark, f"{folder}/a.json") == {"x": None, "y": ["é", 2.5]}
    assert artifacts.latest(spark, [f"{folder}/none*.json", f"{folder}/*.json"]).endswith("/b.json")
    assert artifacts.latest(spark, [f"{folder}/none*"]) is None


def test_frozen_search_keeps_the_other_entries(spark):
    folder = fresh_folder(spark, "frozen")
    artifacts.write_json(spark, f"{folder}/final_model_config.json", {"trees": 3, "postprocess": {"alpha": 1}})
    config = artifacts.freeze_search(spark, folder, {"param_ema_alpha": 0.3, "score": 0.9}, "valid", {"fp": 0.02})
    assert config == artifacts.read_json(spark, f"{folder}/final_model_config.json")
    assert config["trees"] == 3 and config["postprocess"] == {"ema_alpha": 0.3} and config["postprocess_optimization"]["metrics"] == {"score": 0.9}


def test_window_contract_faults_are_told(spark):
    w = spark.createDataFrame([("valid", "a", 1, 0, 0.7), ("valid", "a", 1, 1, 0.2), ("test", "b", 0, 0, 0.1)], "split string, sample_name string, target int, window_index int, prob_raw double")
    path = fresh_folder(spark, "faults")
    artifacts.write_windows(w, path, 5.0, 1.0, 0.5, {"m": 1}, ["x"])
    got = artifacts.read_windows(spark, path, "valid").orderBy("window_index").collect()
    assert [(r["start_sec"], r["end_sec"], r["pred_raw"], r["quality"]) for r in got] == [(0.0, 5.0, 1, 1.0), (1.0, 6.0, 0, 1.0)]
    with pytest.raises(ValueError, match="model_fingerprint is"):
        artifacts.read_windows(spark, path, "valid", {"model_fingerprint": {"m": 2}})
    with pytest.raises(ValueError, match="no windows"):
        artifacts.read_windows(spark, path, "train")
    artifacts.write_windows(w.where("split = 'test'"), path, 3.0, -1.0, 0.5)
    assert artifacts.read_windows(spark, path, "valid").count() == 2  # the other split stays
    with pytest.raises(ValueError, match="stride_sec is not positive"):
        artifacts.read_windows(spark, path, "test")
    assert artifacts.contract_faults(w)[0].startswith("missing columns")


def test_swaps_of_short_sets_repeats_and_nulls(spark):
    rows = [(1, ["a", "b"], ["b", None, "c", "c", "d"]), (2, ["a"], ["a"]), (3, [], ["x"]), (4, ["a", "a"], ["b"])]
    s = spark.createDataFrame(rows, "k int, base array<string>, ranked array<string>")
    got = {(r["k"], r["candidate"]): r["features"] for r in subsets.local_swaps(s, "base", "ranked").collect()}
    assert got == {(1, 0): ["c", "b"], (1, 1): ["d", "b"], (1, 2): ["a", "c"], (1, 3): ["a", "d"], (4, 0): ["b", "a"], (4, 1): ["a", "b"]}
    assert subsets.local_swaps(s, "base", "ranked", most=1).where("k = 1").count() == 1
    assert subsets.local_swaps(s, "base", "ranked", tail=0).count() == 0


def test_candidates_of_missing_scores(spark):
    r = spark.createDataFrame([("a", "frequency", 1, None, None, None), ("b", "frequency", 2, None, 0.1, 1.0), ("c", "x", 3, 0.2, None, None)], "feature string, grp string, position int, score double, fp_rate double, cost double")
    got = {}
    for row in subsets.candidates(r, {"frequency": 1, "x": 0}).orderBy("strategy", "place").collect():
        got.setdefault(row["strategy"], []).append(row["feature"])
    assert got["accuracy_first_15"] == ["a"] and got["fp_safe_15"] == ["b"] and got["deployment_light_15"] == ["b"] and got["accuracy_beam_stability"] == ["a"]


def test_unedited_selection_has_no_faults(spark):
    g = spark.createDataFrame([(0, "f", 0.1 + 0.2, "Hz", True), (1, "g", None, None, False)], "row int, feature string, score double, unit string, eligible boolean")
    e = g.select("row", "feature", F.col("score").cast("string").alias("score"), F.coalesce("unit", F.lit("")).alias("unit"), F.when(F.col("row") == 0, "1").otherwise("0").alias("selected"))
    there = g.select("feature")
    assert subsets.selection_faults(e, g, there, ["score"], ["unit"]).count() == 0
    faults = subsets.selection_faults(e.withColumn("selected", F.lit("1")), g, there, ["score"], ["unit"]).collect()
    assert [(r["row"], r["fault"]) for r in faults] == [(1, "not eligible")]
