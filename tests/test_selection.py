"""Kernels against literal loops; selection on data whose answer is known."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from kymo.operators import kernels, ml, selection
from kymo.plans import registry


def test_bandpass_keeps_the_band_only():
    t = np.arange(400) / 25
    kept, gone = (kernels.bandpass(np.sin(2 * np.pi * f * t))[100:300].std() for f in (2.0, 11.5))
    assert gone < 0.02 * kept and np.array_equal(kernels.bandpass(t[:10]), t[:10])


@pytest.mark.parametrize("seed", range(3))
def test_complexity_equals_loops(seed):
    x = np.random.default_rng(seed).normal(size=40)
    r, n = 0.2 * x.std(), len(x)
    hits = [[sum(max(abs(x[i + k] - x[j + k]) for k in range(m)) <= r for j in range(n - m)) for i in range(n - m)] for m in (2, 3)]
    phi = [np.mean([np.log(h / len(hs)) for h in hs]) for hs in hits]
    b, a = (sum(hs) - len(hs) for hs in hits)
    _, apen, sampen = kernels.complexity(x)
    assert np.isclose(apen, phi[0] - phi[1]) and np.isclose(sampen, -np.log(a / b) if a and b else 0.0)


def test_complexity_of_flat_and_short_windows():
    assert kernels.complexity(np.zeros(9)) == (0, 0, 0) and kernels.complexity(np.ones(20))[1:] == (0, 0)


def _data(spark):
    return spark.range(2000).select("id", (F.col("id") * 7919 % 97).cast("double").alias("good"), (F.col("id") * 104729 % 89).cast("double").alias("noise"), (F.col("id") % 2).alias("fold")).withColumn("label", (F.col("good") > 48).cast("int"))


def test_permutation_finds_the_useful_feature(spark):
    d = _data(spark)
    model = ml.fit_trees(d, ["good", "noise"], "label", trees=1, depth=1)
    auc, loss = selection.permutation_importance(model, d, ["good", "noise"], "label", "id")
    assert auc == 1.0 and loss["good"] > 0.3 and loss["noise"] == 0.0


def test_search_is_resumable_and_prefers_accuracy(spark, tmp_path):
    d, grid, cache = _data(spark), [{"trees": 1, "depth": 1}, {"trees": 1, "depth": 2}], f"file://{tmp_path}/cache"
    one = selection.staged_search(d, ["good", "noise"], "label", "fold", 2, grid, 1, cache)
    assert [r["candidate"] for r in one] == [0] and one[0]["accuracy"] == 1.0
    assert selection.staged_search(d.where("false"), ["good", "noise"], "label", "fold", 2, grid, 1, cache) == one


def test_consistency():
    rho, overlap, only = selection.consistency({f"f{i}": 9.0 - i for i in range(9)}, {f"f{i}": float(i) for i in range(9)}, 2)
    assert np.isclose(rho, -1) and overlap == 0 and only == ["f0", "f1"]


def test_components_are_those_of_the_whole_embedding(spark, tmp_path):
    x = np.random.default_rng(3).normal(size=(60, 20))
    x[:, 17:] = x[:, 17:18] + 0.1 * x[:, 17:]
    spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "vec_id long, embedding array<double>").write.parquet(f"{tmp_path}/embeddings.parquet")
    got = np.array([list(r)[1:] for r in registry.QUERIES["embedding_components"](spark, str(tmp_path)).orderBy("vec_id").collect()])
    z = (x - x.mean(axis=0)) / x.std(axis=0, ddof=1)
    want = z @ np.linalg.svd(z, full_matrices=False)[2][:3].T
    assert np.allclose(np.abs(got), np.abs(want), atol=1e-8)


def test_stability_is_registered_in_full(spark, sf_dir, monkeypatch):
    seen = []
    monkeypatch.setattr(ml, "fit_trees", lambda train, *a, seed=42, **k: seen.append((seed, frozenset(r[0] for r in train.select("fold").distinct().collect()))))
    monkeypatch.setattr(selection, "permutation_importance", lambda m, d, features, *a: (0.5 if len(seen) == 1 else 0.6, {f: float(k) for k, f in enumerate(features)}))
    rows = registry.QUERIES["stability_selection"](spark, sf_dir).collect()
    assert sorted(seen, key=str) == sorted([(s, frozenset(range(5)) - {k}) for s in (1, 7, 42) for k in range(5)], key=str)
    assert sorted((r["freq"], r["n"]) for r in rows) == [(0.0, 0), (0.0, 0), (1.0, 14), (1.0, 14)]


@pytest.mark.parametrize("name", ["feature_contract", "fir_bandpass", "window_complexity", "group_gain_preselection", "stability_selection", "importance_consistency", "staged_model_search"])
def test_queries_have_rows(spark, sf_dir, name):
    assert registry.QUERIES[name](spark, sf_dir).count() > 0


def _repeats(spark):
    """Few distinct rows, many times; one row in seven has no good value, one in eleven is NaN."""
    good = F.when(F.col("id") % 7 == 0, None).when(F.col("id") % 11 == 0, float("nan")).otherwise((F.col("id") * 7919 % 5).cast("double"))
    return spark.range(4000).select("id", good.alias("good"), (F.col("id") * 104729 % 3).cast("double").alias("noise"), (F.col("id") % 2).alias("fold"), (F.col("id") * 7919 % 10 > 4).cast("int").alias("label"))


def _watch(monkeypatch):
    seen, fit = [], ml.fit_trees

    def watched(train, *a, **k):
        seen.append((train.count(), train.agg(F.sum(k["weight"])).first()[0] if k.get("weight") else None))
        return fit(train, *a, **k)

    monkeypatch.setattr(ml, "fit_trees", watched)
    return seen


def test_stability_counts_equal_rows(spark, monkeypatch):
    d, seen = _repeats(spark), _watch(monkeypatch)
    rows = selection.stability(d, ["good", "noise"], "label", "id", "fold", 2, seeds=(1, 2), top=1, least_auc=0.0, trees=1, depth=1)
    valid = d.where("good IS NOT NULL AND NOT isnan(good)").groupBy("fold").count().orderBy(F.desc("fold")).collect()
    assert [n for _, n in seen] == [r["count"] for r in valid] * 2 and max(n for n, _ in seen) <= 5 * 3 * 2 and rows[0][4] + rows[1][4] == 4


def test_permutation_from_counts_equals_rows(spark):
    d = _repeats(spark)
    model = ml.fit_trees(d, ["good", "noise"], "label", trees=3, depth=2)
    got = selection.permutation_importance(model, d, ["good", "noise"], "label", "id", 5)
    rows = d.withColumn("b", F.pmod(F.xxhash64("id", F.lit(5)), F.lit(selection.BUCKETS))).withColumn("h", F.xxhash64(F.lit(5), "id")).orderBy("b", "h", "id").collect()
    rings = {}
    for r in rows:
        rings.setdefault(r["b"], []).append(r)
    other = {r["id"]: ring[(k + 1) % len(ring)] for ring in rings.values() for k, r in enumerate(ring)}
    auc = {}
    for which in ("", "good", "noise"):
        table = [(r["label"], *[(other[r["id"]] if f == which else r)[f] for f in ("good", "noise")]) for r in rows]
        probs = [(s["y"], s["prob"]) for s in ml.score(model, spark.createDataFrame(table, "y int, good double, noise double"), ["good", "noise"]).collect()]
        ones, zeros = (np.array([p for y, p in probs if y == k]) for k in (1, 0))
        auc[which] = ((ones[:, None] > zeros).sum() + (ones[:, None] == zeros).sum() / 2) / (len(ones) * len(zeros))
    assert np.isclose(got[0], auc[""]) and all(np.isclose(got[1][f], auc[""] - auc[f]) for f in ("good", "noise"))


def test_search_counts_equal_rows(spark, monkeypatch):
    seen = _watch(monkeypatch)
    rows = selection.staged_search(_repeats(spark), ["good", "noise"], "label", "fold", 2, [{"trees": 1, "depth": 1}, {"trees": 2, "depth": 2}], 1)
    assert len(rows) == 1 and len(seen) == 3 and max(n for n, _ in seen) <= 5 * 3 * 2 and min(w for _, w in seen) > 1500


def test_first_trees_are_those_of_a_smaller_fit(spark):
    d = _repeats(spark).where("NOT isnan(good)")
    large, small = (ml.fit_trees(d, ["good", "noise"], "label", trees=n, depth=2) for n in (5, 2))
    cut = ml.first_trees(large, 2)
    assert cut.totalNumNodes == small.totalNumNodes and list(cut.treeWeights) == list(small.treeWeights)
    probs = [[r["prob"] for r in ml.score(m, d, ["good", "noise"]).orderBy("id").collect()] for m in (cut, small, large)]
    assert probs[0] == probs[1] != probs[2]


def test_search_is_registered_in_full(spark, sf_dir, monkeypatch):
    seen = []

    def measured(df, features, label, fold, k, grid, cache):
        seen.append((fold, k, {(p["trees"], p["depth"]) for p in grid}))
        return [{"accuracy": 0.5, "fpr": 0.0, "nodes": p["trees"] * p["depth"]} for p in grid]

    monkeypatch.setattr(selection, "_measured", measured)
    assert registry.QUERIES["staged_model_search"](spark, sf_dir).count() == 8
    assert seen[0] == ("fold", 0, {(n, d) for n in range(20, 51, 5) for d in range(2, 6)})
    assert sorted(s[:2] for s in seen[1:]) == [("fold", 1), ("fold", 2), ("fold2", 0), ("fold2", 1), ("fold2", 2)] and all(len(s[2]) == 8 for s in seen[1:])
