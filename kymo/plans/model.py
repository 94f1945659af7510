"""Queries: feature windows, group splits, trees, calibration, components."""

from __future__ import annotations

from pyspark.sql import functions as F

from kymo.functions.exprs import mult_hash
from kymo.operators import features, kernels, ml, selection
from kymo.plans.base import CHANNELS, E_SQL, events, lines, query
from kymo.sources.tables import table

_GROUPS = f"WITH {E_SQL}, g AS (SELECT user_id, CASE WHEN avg(label)>=0.4 THEN 1 ELSE 0 END AS label FROM e GROUP BY 1)"


def _groups(spark, sf_dir):
    return events(spark, sf_dir).groupBy("user_id").agg((F.avg("label") >= 0.4).cast("int").alias("label"))


@query(f"{_GROUPS}, s AS (SELECT *, (row_number() OVER (PARTITION BY label ORDER BY (user_id*2654435761)%4294967296, user_id)-1)/count(*) OVER (PARTITION BY label) AS share FROM g) SELECT user_id, label, CASE WHEN share<0.15 THEN 'test' WHEN share<0.3 THEN 'valid' ELSE 'train' END AS split FROM s")
def group_split(spark, sf_dir):
    return ml.split_groups(_groups(spark, sf_dir), "user_id", "label")


@query(f"{_GROUPS} SELECT user_id, label, ntile(5) OVER (PARTITION BY label ORDER BY (user_id*2654435761)%4294967296, user_id)-1 AS fold FROM g")
def group_folds(spark, sf_dir):
    return ml.group_folds(_groups(spark, sf_dir), "user_id", "label", 5)


@query()
def feature_cleaning(spark, sf_dir):
    x = lines(spark, sf_dir).where("split = 'train'").withColumn("price_cents", F.col("price") * 100).withColumn("constant", F.lit(1.0)).withColumn("holes", F.when(F.col("l_orderkey") % 2 == 0, F.col("tax")))
    verdicts = ml.clean_features(x, [*CHANNELS, "price_cents", "constant", "holes"], "label")
    return spark.createDataFrame(verdicts, "feature string, verdict string")


def _windows(spark, sf_dir):
    a = F.col("embedding").cast("array<double>")
    return table(spark, sf_dir, "embeddings").select("vec_id", "label", a.alias("g1"), F.transform(a, lambda v: v * 2 + 1).alias("g2"), F.reverse(a).alias("g3"), F.transform(a, lambda v: v * v).alias("amb"), a.alias("ax"), F.reverse(a).alias("ay"), F.transform(a, lambda v: v + 1).alias("az"))


@query()
def feature_pool(spark, sf_dir):
    """Every governed feature of every stored window."""
    return features.extract(_windows(spark, sf_dir), "vec_id", "amb", ["g1", "g2", "g3"], ["ax", "ay", "az"])


@query()
def feature_pool_selected(spark, sf_dir):
    """Three requested features: only their families are computed."""
    return features.extract(_windows(spark, sf_dir), "vec_id", "amb", ["g1", "g2", "g3"], requested=["GREEN_AC_RMS", "GTOP2_DOM_FREQ", "G_bp_corr_mean"])


@query()
def gbt_threshold_eval(spark, sf_dir):
    """Boosted trees on the training split, the threshold chosen on the validation split, judged there."""
    x = lines(spark, sf_dir)
    model = ml.fit_trees(x.where("split = 'train'"), CHANNELS, "label", trees=5)
    return ml.best_threshold(ml.score(model, x.where("split = 'valid'"), CHANNELS), "label")


@query()
def tree_usage(spark, sf_dir):
    model = ml.fit_trees(lines(spark, sf_dir).where("split = 'train'"), CHANNELS, "label", trees=3)
    return spark.createDataFrame(ml.tree_nodes(model, CHANNELS), "feature string, n_splits int")


@query()
def isotonic_calibration(spark, sf_dir):
    return ml.calibrate(events(spark, sf_dir).select("event_id", "label", "prob"), "label").select("event_id", "prob", "calibrated")


@query()
def embedding_components(spark, sf_dir):
    """Three components of the whole embedding."""
    e = table(spark, sf_dir, "embeddings")
    width = e.agg(F.max(F.size("embedding"))).first()[0]
    x = e.select("vec_id", *[F.get("embedding", F.lit(k)).cast("double").alias(f"x{k}") for k in range(width)])
    return ml.principal_components(x, "vec_id", [f"x{k}" for k in range(width)], 3)


@query()
def feature_contract(spark, sf_dir):
    """The governed features in order, as a table."""
    return spark.createDataFrame(list(enumerate(features.CATALOGUE)), "position int, feature string")


@query()
def fir_bandpass(spark, sf_dir):
    """Stored windows after the zero-phase band-pass, with 33 taps: they hold 64 points."""
    e = table(spark, sf_dir, "embeddings")
    return e.select("vec_id", F.posexplode(kernels.bandpassed(e, F.col("embedding").cast("array<double>"), taps=33)).alias("pos", "value"))


@query()
def window_complexity(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    return e.select("vec_id", kernels.complexities(e, F.col("embedding").cast("array<double>")).alias("c")).select("vec_id", "c.*")


def _folded(spark, sf_dir):
    x = lines(spark, sf_dir).where("split <> 'test'")
    return x.withColumn("fold", mult_hash(F.col("l_orderkey")) % 2).withColumn("row", F.struct("l_orderkey", "l_linenumber", "l_suppkey", "l_shipdate"))


@query()
def group_gain_preselection(spark, sf_dir):
    rows = selection.gains_by_group(_folded(spark, sf_dir), {"size": ["quantity", "price"], "rate": ["discount", "tax"]}, "label", trees=2)
    return spark.createDataFrame(rows, "feature_group string, feature string, place int, gain double")


@query()
def stability_selection(spark, sf_dir):
    """Permutation importance over three seeds and five group folds: which features are among the best two of folds that tell the labels."""
    x = _folded(spark, sf_dir).withColumn("fold", mult_hash(F.col("l_orderkey")) % 5)
    rows = selection.stability(x, CHANNELS, "label", "row", "fold", 5, seeds=(1, 7, 42), top=2)
    return spark.createDataFrame(rows, "feature string, freq double, importance double, place double, n int")


@query()
def importance_consistency(spark, sf_dir):
    """Importances on the rows a model was trained on against those on other rows."""
    x = _folded(spark, sf_dir)
    train = x.where("split = 'train'")
    model = ml.fit_trees(train, CHANNELS, "label", trees=2)
    a, b = (selection.permutation_importance(model, d, CHANNELS, "label", "row")[1] for d in (train, x.where("split = 'valid'")))
    rho, overlap, only = selection.consistency(a, b, 2)
    return spark.createDataFrame([(rho, overlap, only)], "rho double, overlap double, first_only array<string>")


@query()
def staged_model_search(spark, sf_dir):
    """The reference's axes of tree count and depth, its balanced eight finalists, and three group folds in two repeats."""
    x = _folded(spark, sf_dir).withColumn("fold", mult_hash(F.col("l_orderkey")) % 3).withColumn("fold2", F.pmod(F.xxhash64(F.lit(43), "l_orderkey"), F.lit(3)))
    grid = [{"trees": n, "depth": d} for n in (20, 25, 30, 35, 40, 45, 50) for d in (2, 3, 4, 5)]
    rows = selection.staged_search(x, CHANNELS, "label", ["fold", "fold2"], 3, grid, 8)
    return spark.createDataFrame(rows, "candidate int, trees int, depth int, accuracy double, std double, fpr double, nodes int")
