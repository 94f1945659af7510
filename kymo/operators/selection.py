"""Model-based selection: gains by group, permutation importance over folds, consistency, staged search.

Rows stay distributed: a permutation is a cyclic shift inside hash buckets (one
shuffle), and all permuted variants of a fold are scored and ranked in one plan.
Only tables of features, folds and candidates reach the driver.

Trees look at no more than ``ml.BINS`` values of a feature.  Folds are therefore
binned once, by the rows that a model is trained on, and trees grow from the
counts of equal rows; a scored row stands for all rows that a model can not
tell apart.  No row is left out, and each counts as often as it occurs.
"""

from __future__ import annotations

import hashlib
import json
from concurrent.futures import ThreadPoolExecutor

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kymo.operators import ml
from kymo.operators.metrics import rank_auc
from kymo.session import cut

BUCKETS = 1024
#: Folds of a search, and fits and judgements of a fold, that run side by side.
WORKERS = 8


def gains_by_group(train: DataFrame, groups: dict[str, list[str]], label: str, top: int = 4, trees: int = 10, depth: int = 3) -> list[tuple[str, str, int, float]]:
    """(group, feature, rank, gain) of the best ``top`` features of every group; a lone feature has gain 1."""
    out = []
    for group, names in groups.items():
        gain = [1.0] if len(names) == 1 else ml.fit_trees(train, names, label, trees, depth).featureImportances.toArray()
        best = sorted(zip(names, gain, strict=True), key=lambda x: -x[1])[:top]
        out += [(group, f, k, float(g)) for k, (f, g) in enumerate(best, 1)]
    return out


def permutation_importance(model, df: DataFrame, features: list[str], label: str, key: str, seed: int = 42) -> tuple[float, dict[str, float]]:
    """AUC of the model, and what it loses when a feature's values are exchanged between rows."""
    bucket = F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(BUCKETS))
    limits = ml.thresholds(model, features)
    place = {f: F.when(F.col(f).isNotNull() & ~F.isnan(F.col(f).cast("double")), ml._above(F.col(f).cast("double"), limits[f])) for f in features}
    d = df.select(key, F.col(label).cast("int").alias("y"), F.struct(*[place[f].alias(f) for f in features]).alias("_own"), bucket.alias("_b"), F.xxhash64(F.lit(seed), key).alias("_h"))
    ring = Window.partitionBy("_b").orderBy("_h", key)
    first = F.first("_own").over(ring.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    d = d.withColumn("_other", F.coalesce(F.lead("_own").over(ring), first))
    variants = [F.struct(F.lit("").alias("which"), "_own.*")] + [F.struct(F.lit(f).alias("which"), *[F.col(f"{'_other' if g == f else '_own'}.{g}").alias(g) for g in features]) for f in features]
    alike = ml.cells(d.select("y", F.explode(F.array(*variants)).alias("v")).select("y", "v.*"), ["which", "y", *features], "_n")
    # a value of each place, to be scored for all: the threshold that ends it, or one beyond the last
    ends = {f: F.array(*[F.lit(t) for t in [*limits[f], limits[f][-1] + abs(limits[f][-1]) + 1.0 if limits[f] else 0.0]]) for f in features}
    scored = ml.score(model, alike.select("which", "y", "_n", *[F.get(ends[f], F.col(f)).alias(f) for f in features]), features)
    auc = {r["which"]: r["auc"] for r in rank_auc(scored, ["which"], "prob", "y", "_n").collect()}  # one row a feature
    base = auc.get("")
    return (0.5, dict.fromkeys(features, 0.0)) if base is None else (base, {f: base - auc[f] for f in features})


def _binned(df: DataFrame, features: list[str], label: str, fold: str, k: int, key: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Equal rows outside fold ``k``, counted in ``_n``, and the rows in it, counted alike where no ``key`` is asked for; bins are those of the former."""
    train = df.where(F.col(fold) != k)
    edges = ml.bin_edges(train, features)
    held_out = ml.binned(df.where(F.col(fold) == k), features, edges)
    held_out = ml.cells(held_out, [label, *features], "_n") if key is None else held_out.select(key, label, *features)
    return cut(ml.cells(ml.binned(train, features, edges), [fold, label, *features], "_n"), "train"), cut(held_out, "held_out")


def stability(df: DataFrame, features: list[str], label: str, key: str, fold: str, folds: int, seeds: tuple[int, ...] = (42,), top: int = 10, least_auc: float = 0.55, trees: int = 10, depth: int = 2) -> list[tuple[str, float, float, float, int]]:
    """(feature, frequency, mean importance, mean rank, count) over seeds and folds; folds below ``least_auc`` do not vote."""
    votes: dict[str, list[tuple[float, int]]] = {f: [] for f in features}
    runs = 0
    binned = [_binned(df, features, label, fold, k, key) for k in range(folds)]
    for seed in seeds:
        for train, held_out in binned:
            model = ml.fit_trees(train, features, label, trees, depth, weight="_n", seed=seed)
            auc, importance = permutation_importance(model, held_out, features, label, key, seed)
            if auc < least_auc:
                continue
            runs += 1
            for rank, f in enumerate(sorted(features, key=lambda f: -importance[f])[:top], 1):
                votes[f].append((importance[f], rank))
    rows = [(f, len(v) / max(runs, 1), sum(i for i, _ in v) / max(len(v), 1), sum(r for _, r in v) / max(len(v), 1), len(v)) for f, v in votes.items()]
    return sorted(rows, key=lambda r: (-r[1], -r[2], r[3], r[0]))


def consistency(first: dict[str, float], second: dict[str, float], top: int = 10) -> tuple[float, float, list[str]]:
    """Spearman correlation of two importances, overlap of their best ``top``, and features strong in the first only."""
    import pandas as pd

    a, b = pd.Series(first), pd.Series(second)[list(first)]
    k = min(top, len(a))
    rho = a.rank().corr(b.rank()) if a.nunique() > 1 and b.nunique() > 1 else 0.0
    best = [set(s.sort_values(ascending=False, kind="stable").index[:k]) for s in (a, b)]
    place = b.rank(ascending=False, method="first")
    return float(rho), len(best[0] & best[1]) / k, sorted(f for f in best[0] if place[f] > 2 * k)


def _measured(df: DataFrame, features: list[str], label: str, fold: str, k: int, grid: list[dict], cache: str | None) -> list[dict]:
    """Metrics of every candidate on one fold, read from the cache where a former run left them; candidates of one depth share a fit of the most trees."""
    spark = df.sparkSession
    names = [hashlib.sha256(json.dumps([sorted(features), label, fold, k, p, ml.BINS], sort_keys=True).encode()).hexdigest() for p in grid]
    done: dict[int, dict] = {}
    for i, name in enumerate(names):
        if cache:
            try:
                done[i] = spark.read.parquet(f"{cache}/{name}").first().asDict()
            except AnalysisException:
                pass  # not measured yet
    todo = [i for i in range(len(grid)) if i not in done]
    if not todo:
        return [done[i] for i in range(len(grid))]
    train, held_out = _binned(df, features, label, fold, k)
    depths = sorted({grid[i]["depth"] for i in todo})
    with ThreadPoolExecutor(WORKERS) as pool:
        fits = pool.map(lambda d: ml.fit_trees(train, features, label, max(grid[i]["trees"] for i in todo if grid[i]["depth"] == d), d, weight="_n"), depths)
        models = dict(zip(depths, fits, strict=True))

        def judged(i: int) -> dict:
            model = ml.first_trees(models[grid[i]["depth"]], grid[i]["trees"])
            found = ml.best_threshold(ml.score(model, held_out, features), label, weight="_n").withColumn("nodes", F.lit(int(model.totalNumNodes)))
            if cache:
                found.write.mode("overwrite").parquet(f"{cache}/{names[i]}")
                found = spark.read.parquet(f"{cache}/{names[i]}")
            return found.first().asDict()

        done |= zip(todo, pool.map(judged, todo), strict=True)
    return [done[i] for i in range(len(grid))]


def staged_search(df: DataFrame, features: list[str], label: str, fold: str | list[str], folds: int, grid: list[dict], finalists: int, cache: str | None = None, max_nodes: int = 500) -> list[dict]:
    """Every candidate on the first fold, the best ``finalists`` on all folds; rows in order of preference.

    Several ``fold`` columns are repeats of the division into folds.
    Order: mean accuracy, then fewer false positives, then a smaller spread, then
    a smaller model, then the grid's own order.  Candidates over ``max_nodes`` are out.
    ``cache`` names a folder of the shared store that lets a broken search go on; it belongs to one dataset.
    """
    splits = [(c, k) for c in ([fold] if isinstance(fold, str) else fold) for k in range(folds)]
    first = list(zip(range(len(grid)), grid, _measured(df, features, label, *splits[0], grid, cache), strict=True))
    fit = [c for c in first if c[2]["nodes"] <= max_nodes]
    best = sorted(fit, key=lambda c: (-c[2]["accuracy"], c[2]["fpr"], c[2]["nodes"], c[0]))[:finalists]
    with ThreadPoolExecutor(WORKERS) as pool:
        others = list(pool.map(lambda split: _measured(df, features, label, *split, [p for _, p, _ in best], cache), splits[1:])) if best else []
    rows = []
    for n, (i, p, m) in enumerate(best):
        all_ = [m, *(found[n] for found in others)]
        acc = [x["accuracy"] for x in all_]
        mean = sum(acc) / len(acc)
        spread = (sum((x - mean) ** 2 for x in acc) / len(acc)) ** 0.5
        rows.append({"candidate": i, **p, "accuracy": mean, "std": spread, "fpr": sum(x["fpr"] for x in all_) / len(all_), "nodes": max(x["nodes"] for x in all_)})
    return sorted(rows, key=lambda r: (-r["accuracy"], r["fpr"], r["std"], r["nodes"], r["candidate"]))
