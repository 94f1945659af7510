"""Candidate feature sets, local swaps, the workload estimate, and the contracts of windows and manual selections."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The groups that a beam prefers, in order; groups that a beam does not name follow in the order of FOCUS.
FOCUS = ["green_contact", "green_top2_contact", "green_spatial", "frequency", "pulse_shape", "ambient_cross", "acc_motion", "acc_green_coupling"]
BEAMS = {
    "accuracy_beam_green_top2": ["green_contact", "green_top2_contact", "frequency", "green_spatial", "acc_green_coupling", "ambient_cross"],
    "accuracy_beam_stability": ["pulse_shape", "green_spatial", "green_top2_contact", "green_contact", "frequency", "acc_motion"],
    "accuracy_beam_motion_light": ["acc_motion", "acc_green_coupling", "green_contact", "frequency", "ambient_cross"],
}


def _lookup(values: Mapping[str, float], of: Column, default: float) -> Column:
    if not values:
        return F.lit(default)
    return F.coalesce(F.create_map(*[F.lit(x) for kv in values.items() for x in kv])[of], F.lit(default))


def candidates(ranking: DataFrame, limits: Mapping[str, int], baseline: Sequence[str] = (), max_cost: float = 4.0, most: int = 15, fewer: int = 12, per_group: int = 2) -> DataFrame:
    """Nine named candidate sets out of (feature, grp, position, score, fp_rate, cost), one row a feature and set.

    A set takes features in its own order, at most ``limits[grp]`` of a group (``per_group`` where not named).
    A null score counts 0, a null rate 0.5, a null cost 2; ties go by ``position``. The baseline set keeps the
    order of ``baseline`` and has no group limit. Windows run over one row a feature and set.
    """
    score, rate, cost = F.coalesce("score", F.lit(0.0)), F.coalesce("fp_rate", F.lit(0.5)), F.coalesce("cost", F.lit(2.0))
    r = ranking.select("feature", "grp", "position", score.alias("score"), rate.alias("fp_rate"), cost.alias("cost"))
    r = r.withColumn("within", F.row_number().over(Window.partitionBy("grp").orderBy(F.desc("score"), "position")))
    score, rate, cost = F.col("score"), F.col("fp_rate"), F.col("cost")
    balanced = 0.4 * score + 0.3 * (1.0 - rate) + 0.3 * (1.0 - cost / max_cost)
    orders: dict[str, tuple[int, Column, Column]] = {
        f"accuracy_first_{most}": (most, -score, F.lit(0.0)),
        f"fp_safe_{most}": (most, rate, -score),
        f"deployment_light_{most}": (most, cost, -score),
        f"balanced_{most}": (most, -balanced, F.lit(0.0)),
        f"balanced_{fewer}": (fewer, -balanced, F.lit(0.0)),
    }
    for name, preferred in BEAMS.items():
        order = preferred + [g for g in FOCUS if g not in preferred]
        turn = _lookup({g: float(k) for k, g in enumerate(order)}, F.col("grp"), float(len(order)))
        orders[name] = (most, F.when(F.col("within") <= 3, turn).otherwise(float(len(order))), -score)
    limit = _lookup({g: float(n) for g, n in limits.items()}, F.col("grp"), float(per_group))
    entries = [F.struct(F.lit(s).alias("strategy"), F.lit(n).alias("n"), a.cast("double").alias("first"), b.cast("double").alias("second"), limit.alias("limit")) for s, (n, a, b) in orders.items()]
    if baseline:
        at = F.array_position(F.array(*map(F.lit, baseline)), F.col("feature")).cast("double")
        entries.append(F.struct(F.lit(f"commercial_{len(baseline)}_baseline").alias("strategy"), F.lit(len(baseline)).alias("n"), F.when(at > 0, at).alias("first"), F.lit(0.0).alias("second"), F.lit(float(len(baseline))).alias("limit")))
    e = r.select("feature", "grp", "position", F.explode(F.array(*entries)).alias("e")).select("feature", "grp", "position", "e.*").where("first IS NOT NULL")
    order = ["first", "second", "position"]
    e = e.withColumn("in_group", F.row_number().over(Window.partitionBy("strategy", "grp").orderBy(*order))).where("in_group <= limit")
    return e.withColumn("place", F.row_number().over(Window.partitionBy("strategy").orderBy(*order)).cast("long")).where("place <= n").select("strategy", "place", "feature", "grp")


def local_swaps(sets: DataFrame, base: str, ranked: str, tail: int = 3, pool: int = 8, most: int = 12) -> DataFrame:
    """Sets of the same size that differ from ``base`` in one of its last ``tail`` places, first places and best ranked newcomers first.

    Adds ``candidate`` (from 0) and ``features``; sets with a feature twice are left out, rows without a newcomer give none.
    """
    b, fresh = F.col(base), F.slice(F.array_except(F.array_compact(F.col(ranked)), F.col(base)), 1, pool)
    n, steps = F.size(b), F.least(F.lit(tail), F.size(b)) * F.size(fresh)

    def swapped(j: Column) -> Column:
        at = n - F.least(F.lit(tail), n) + F.floor(j / F.size(fresh)).cast("int")
        new = F.get(fresh, (j % F.size(fresh)).cast("int"))
        return F.transform(b, lambda x, i: F.when(i == at, new).otherwise(x))

    every = F.transform(F.when(steps > 0, F.sequence(F.lit(0), steps - 1)).otherwise(F.array().cast("array<int>")), swapped)
    kept = F.slice(F.filter(every, lambda c: F.size(F.array_distinct(c)) == F.size(c)), 1, most)
    others = [c for c in sets.columns if c not in (base, ranked)]
    return sets.select(*others, F.posexplode(kept).alias("candidate", "features"))


def workload(sizes: DataFrame, skip_vif: bool = False, shap: bool = False, subset_search: bool = False) -> DataFrame:
    """Selection steps with their risk and number of work items, from n_train_rows, n_valid_rows, n_features and n_samples (null: 0)."""
    train, valid, features, samples = (F.coalesce(F.col(c), F.lit(0)).cast("long") for c in ("n_train_rows", "n_valid_rows", "n_features", "n_samples"))
    folds = 3 * F.least(F.lit(5).cast("long"), F.greatest(samples, F.lit(0).cast("long")))
    points = lambda *tests: sum((t.cast("int") for t in tests), F.lit(1))
    risk = lambda p: F.when(p >= 3, "high").when(p >= 2, "medium").otherwise("low")
    long = train >= 10000
    steps = [
        ("clean", risk(points() if skip_vif else points(features >= 40, features >= 80, long)), features),
        ("stability", risk(points(folds >= 12, features >= 60, long)), folds),
        ("shap", risk(points(long, features >= 60) if shap else F.lit(0)), train * F.greatest(features, F.lit(1)) if shap else F.lit(0)),
        ("diagnostics", risk(points(features >= 80, train + valid >= 20000)), features),
    ]
    if subset_search:
        steps.append(("subset_search", F.lit("medium"), F.lit(6)))
    rows = F.array(*[F.struct(F.lit(s).alias("step"), r.alias("risk"), w.cast("long").alias("work_items")) for s, r, w in steps])
    others = [c for c in sizes.columns if c not in ("n_train_rows", "n_valid_rows", "n_features", "n_samples")]
    return sizes.select(*others, F.explode(rows).alias("r")).select(*others, "r.*")


def window_contract_fault(actual: Mapping[str, Column], trained: Mapping[str, Column], tolerance: float = 1e-9) -> Column:
    """First reason why given window settings (as text) do not match those a model was trained with; null where they do."""
    reasons = []
    for name, given in actual.items():
        want = trained[name]
        a, b = given.try_cast("double"), want.try_cast("double")
        finite = lambda x: ~F.isnan(x) & (F.abs(x) != float("inf"))
        reasons.append(
            F.when(want.isNull(), f"{name} required").when(a.isNull() | b.isNull(), f"{name} not numeric").when(~finite(a) | ~finite(b), f"{name} not finite")
            .when(F.abs(a - b) > tolerance + tolerance * F.abs(b), f"{name} differs")
        )
    return F.coalesce(*reasons)


def native_duration(samples: DataFrame, by: list[str], seconds: Sequence[int] = (3, 5)) -> DataFrame:
    """The one window length that the stored windows of each group share, from ``shape`` (three sizes: stored windows) and ``frequency``.

    ``fault`` tells of a sample that fits two lengths (ambiguous) or of a group with two (mixed); records that are
    not pre-windowed or have no numeric frequency take no part.
    """
    rate = F.col("frequency").try_cast("int")
    fits = [(F.size("shape") == 3) & F.array_contains(F.slice("shape", 2, 2), (rate * s).cast("int")) for s in seconds]
    found = samples.select(*by, *[F.coalesce(f, F.lit(False)).cast("int").alias(f"s{s}") for f, s in zip(fits, seconds, strict=True)])
    hits = [f"s{s}" for s in seconds]
    g = found.groupBy(*by).agg(*[F.max(h).alias(h) for h in hits], F.max(sum((F.col(h) for h in hits), F.lit(0))).alias("most"))
    kinds = sum((F.col(h) for h in hits), F.lit(0))
    fault = F.when(F.col("most") > 1, "ambiguous").when(kinds > 1, "mixed")
    return g.select(*by, F.when(fault.isNull(), F.coalesce(*[F.when(F.col(f"s{s}") == 1, s) for s in seconds])).cast("long").alias("window_sec"), fault.alias("fault"))


def stored_windows(records: DataFrame, window_sec: float, stride_sec: float, frequency: int) -> DataFrame:
    """Times and targets of windows that were cut before: no second windowing, start = index * stride.

    Takes position, window_index (null: the position), window_label (null: the sample's target), target and length;
    adds ``error`` where the stored length is not that of the asked window.
    """
    number = F.coalesce("window_index", "position")
    start = number * F.lit(float(stride_sec))
    want = int(round(window_sec * frequency))
    error = F.when(F.col("length") != want, F.concat(F.lit("window has "), F.col("length").cast("string"), F.lit(f" samples, not {want}")))
    others = [c for c in records.columns if c not in ("position", "window_index", "window_label", "target", "length")]
    return records.select(*others, number.cast("long").alias("window_number"), F.coalesce("window_label", "target").cast("long").alias("window_target"), start.alias("start_sec"), (start + float(window_sec)).alias("end_sec"), error.alias("error"))


def selection_faults(edited: DataFrame, governed: DataFrame, available: DataFrame, numbers: Sequence[str] = (), texts: Sequence[str] = ()) -> DataFrame:
    """Faults of a manual selection, one row each: only ``selected`` may differ from the governed table.

    Both tables hold ``row`` (their order), ``feature`` and the fixed columns, which are text in the edited one;
    the governed one holds ``eligible`` too. ``available`` lists, by ``feature``, what training and validation tables both have.
    A fixed number may differ by 1e-12, relative or absolute; a missing one has to stay empty.
    """
    e = edited.select("row", "selected", *[F.col(c).alias(f"e_{c}") for c in ("feature", *numbers, *texts)])
    g = governed.select("row", "eligible", *[F.col(c).alias(f"g_{c}") for c in ("feature", *numbers, *texts)])
    j = e.withColumn("in_e", F.lit(1)).join(g.withColumn("in_g", F.lit(1)), "row", "full")
    j = j.join(available.select(F.col("feature").alias("e_feature")).distinct().withColumn("there", F.lit(1)), "e_feature", "left")
    both, chosen = F.col("in_e").isNotNull() & F.col("in_g").isNotNull(), F.col("selected") == "1"
    empty = lambda c: F.coalesce(F.col(f"e_{c}"), F.lit("")) == ""

    def changed(c: str, number: bool) -> Column:
        given, want = F.col(f"e_{c}"), F.col(f"g_{c}")
        if number:
            a, b = given.try_cast("double"), want.cast("double")
            equal = F.abs(a - b) <= F.greatest(F.lit(1e-12), 1e-12 * F.greatest(F.abs(a), F.abs(b)))
        else:
            equal = given == want
        return ~F.coalesce(F.when(want.isNull(), empty(c)).otherwise(equal), F.lit(False))

    nth = F.row_number().over(Window.partitionBy("e_feature", F.coalesce(chosen, F.lit(False))).orderBy("row"))
    j = j.withColumn("again", chosen & (nth > 1))
    tests = [(F.col("in_e").isNull(), "row missing"), (F.col("in_g").isNull(), "row added")]
    tests += [(both & changed(c, c in numbers), f"{c} changed") for c in ("feature", *numbers, *texts)]
    tests += [
        (both & ~F.coalesce(F.col("selected").isin("0", "1"), F.lit(False)), "selected is not 0 or 1"),
        (both & F.col("again"), "selected twice"),
        (both & chosen & ~F.coalesce(F.col("eligible"), F.lit(False)), "not eligible"),
        (both & chosen & F.col("there").isNull(), "not in train and valid"),
    ]
    faults = F.array_compact(F.array(*[F.when(t, f) for t, f in tests]))
    return j.select("row", F.coalesce("g_feature", "e_feature").alias("feature"), F.explode(faults).alias("fault"))
