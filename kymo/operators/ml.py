"""Group-aware splits, cleaning, boosted trees, calibration and importances on Spark ML."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kymo.functions.exprs import guarded_corr, mult_hash

#: Most bins of a feature, as many as a tree looks at, and the quantiles they are chosen from.
BINS, QUANTILES = 32, 1024


def split_groups(groups: DataFrame, key: str, label: str, valid: float = 0.15, test: float = 0.15) -> DataFrame:
    """``key, label, split`` of a table with one row per group: stratified by label, in hash order."""
    n = F.count(F.lit(1)).over(Window.partitionBy(label))
    r = F.row_number().over(Window.partitionBy(label).orderBy(mult_hash(F.col(key)), key))
    share = (r - 1) / n
    return groups.select(key, label, F.when(share < test, "test").when(share < test + valid, "valid").otherwise("train").alias("split"))


def group_folds(groups: DataFrame, key: str, label: str, k: int) -> DataFrame:
    w = Window.partitionBy(label).orderBy(mult_hash(F.col(key)), key)
    return groups.select(key, label, (F.ntile(k).over(w) - 1).cast("long").alias("fold"))


def clean_features(df: DataFrame, features: list[str], label: str, missing: float = 0.3, variance: float = 1e-8, correlated: float = 0.95, vif: float = 10.0) -> list[tuple[str, str]]:
    """(feature, reason) with ``kept`` or why it went: missing, variance, correlation (the weaker of a pair), collinearity.

    One aggregation gathers the Gram matrix; the k x k rest is solved on the driver.
    """
    import numpy as np

    own = [F.avg(F.col(f).isNull().cast("double")).alias(f"m_{f}") for f in features] + [F.var_samp(f).alias(f"v_{f}") for f in features]
    one = df.agg(*own, *[guarded_corr(F.col(f), F.col(label).cast("double")).alias(f"t_{f}") for f in features])
    stats = one.first()
    verdict = {f: "missing" if stats[f"m_{f}"] > missing else "variance" if (stats[f"v_{f}"] or 0.0) <= variance else "kept" for f in features}
    live = [f for f in features if verdict[f] == "kept"]
    row = df.agg(*[guarded_corr(F.col(a), F.col(b)).alias(f"{i}_{j}") for i, a in enumerate(live) for j, b in enumerate(live) if i < j]).first() if len(live) > 1 else {}
    r = np.eye(len(live))
    for i in range(len(live)):
        for j in range(i + 1, len(live)):
            r[i, j] = r[j, i] = row[f"{i}_{j}"] or 0.0
    strength = [abs(stats[f"t_{f}"] or 0.0) for f in live]
    for i in range(len(live)):
        for j in range(i + 1, len(live)):
            if abs(r[i, j]) > correlated and verdict[live[i]] == verdict[live[j]] == "kept":
                verdict[live[i] if strength[i] < strength[j] else live[j]] = "correlation"
    rest = [i for i, f in enumerate(live) if verdict[f] == "kept"]
    while len(rest) > 1:
        inflation = np.diag(np.linalg.inv(r[np.ix_(rest, rest)] + 1e-9 * np.eye(len(rest))))
        worst = int(inflation.argmax())
        if inflation[worst] <= vif:
            break
        verdict[live[rest.pop(worst)]] = "collinearity"
    return [(f, verdict[f]) for f in features]


def assemble(df: DataFrame, features: list[str], out: str = "features") -> DataFrame:
    from pyspark.ml.feature import VectorAssembler

    return VectorAssembler(inputCols=features, outputCol=out, handleInvalid="skip").transform(df)


def fit_trees(train: DataFrame, features: list[str], label: str, trees: int = 10, depth: int = 3, weight: str | None = None, seed: int = 42):
    from pyspark.ml.classification import GBTClassifier

    gbt = GBTClassifier(featuresCol="features", labelCol=label, maxIter=trees, maxDepth=depth, seed=seed, weightCol=weight) if weight else GBTClassifier(featuresCol="features", labelCol=label, maxIter=trees, maxDepth=depth, seed=seed)
    return gbt.fit(assemble(train, features))


def first_trees(model, trees: int):
    """The model of the first ``trees`` trees: boosting adds trees one after the other, so a fit of that many gives the same."""
    from pyspark import SparkContext
    from pyspark.ml.classification import GBTClassificationModel

    old = model._java_obj
    if trees >= old.getNumTrees():
        return model
    gateway = SparkContext._active_spark_context._gateway
    ml = gateway.jvm.org.apache.spark.ml
    kept = gateway.new_array(ml.regression.DecisionTreeRegressionModel, trees)
    weights = gateway.new_array(gateway.jvm.double, trees)
    for k, (tree, weight) in enumerate(zip(old.trees()[:trees], old.treeWeights()[:trees], strict=True)):
        kept[k], weights[k] = tree, weight
    return GBTClassificationModel(ml.classification.GBTClassificationModel(old.uid(), kept, weights, old.numFeatures(), old.numClasses()))


def _valid(features: list[str]):
    """Whether the assembler takes a row."""
    valid = F.lit(True)
    for f in features:
        valid = valid & F.col(f).isNotNull() & ~F.isnan(F.col(f).cast("double"))
    return valid


def _above(x, limits: list[float]):
    """How many of the limits ``x`` is above."""
    return sum(((x > F.lit(t)).cast("int") for t in limits), F.lit(0))


def bin_edges(df: DataFrame, features: list[str]) -> dict[str, list[float]]:
    """Upper edges of the bins of every feature, from all rows: its values where they are few, quantiles otherwise."""
    at = [k / QUANTILES for k in range(QUANTILES + 1)]
    row = df.where(_valid(features)).agg(*[F.percentile_approx(F.col(f).cast("double"), at).alias(f) for f in features]).first()
    edges = {}
    for f in features:
        found = row[f] or [0.0]
        few = sorted(set(found))
        quantiles = sorted({found[k * QUANTILES // BINS] for k in range(1, BINS)} - {found[-1]})
        edges[f] = few[:-1] if len(few) <= BINS else quantiles
    return edges


def binned(df: DataFrame, features: list[str], edges: dict[str, list[float]]) -> DataFrame:
    """``df`` with the number of its bin in place of every feature; rows that the assembler skips are left out."""
    others = [c for c in df.columns if c not in features]
    return df.where(_valid(features)).select(*others, *[_above(F.col(f).cast("double"), edges[f]).cast("double").alias(f) for f in features])


def cells(df: DataFrame, columns: list[str], rows: str) -> DataFrame:
    """Distinct rows and how many there are; trees grow from these counts as they would from the rows."""
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias(rows))


def thresholds(model, features: list[str]) -> dict[str, list[float]]:
    """Values at which the trees of a model divide each feature, in order; ``x <= threshold`` goes left."""
    import re

    found = re.findall(r"If \(feature (\d+) <= ([^)]+)\)", model.toDebugString)
    return {f: sorted({float(t) for k, t in found if int(k) == i}) for i, f in enumerate(features)}


def score(model, df: DataFrame, features: list[str]) -> DataFrame:
    from pyspark.ml.functions import vector_to_array

    done = model.transform(assemble(df, features))
    return done.withColumn("prob", vector_to_array("probability")[1]).drop("features", "rawPrediction", "probability", "prediction")


def tree_nodes(model, features: list[str]) -> list[tuple[str, int]]:
    """(feature, number of splits) over all trees of a model."""
    import re

    used = [int(x) for x in re.findall(r"If \(feature (\d+)", model.toDebugString)]
    return [(f, used.count(i)) for i, f in enumerate(features)]


def best_threshold(scored: DataFrame, label: str, prob: str = "prob", max_fpr: float | None = None, weight: str | None = None) -> DataFrame:
    """The accuracy-first threshold of 181: one row, lowest threshold among equals.  ``weight`` holds the rows that a row stands for."""
    from kymo.functions.exprs import rates, threshold_grid

    spark = scored.sparkSession
    grid = [r["threshold"] for r in threshold_grid(spark).orderBy("k").collect()]  # 181 constants
    cell = F.aggregate(F.array(*map(F.lit, grid)), F.lit(0), lambda a, t: a + F.when(t <= F.col(prob), 1).otherwise(0))
    cells = scored.where(~F.isnan(prob)).groupBy(cell.alias("cell"), F.col(label).cast("int").alias("y")).agg((F.count(F.lit(1)) if weight is None else F.sum(weight)).alias("n"))
    rows = cells.withColumn("t", F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.lit(t).alias("threshold")) for k, t in enumerate(grid)])))
    sums = rows.groupBy("t.k", "t.threshold").agg(*[F.sum(F.when(c, F.col("n")).otherwise(0)).alias(a) for a, c in {
        "tp": (F.col("cell") > F.col("t.k")) & (F.col("y") == 1), "fp": (F.col("cell") > F.col("t.k")) & (F.col("y") == 0),
        "tn": (F.col("cell") <= F.col("t.k")) & (F.col("y") == 0), "fn": (F.col("cell") <= F.col("t.k")) & (F.col("y") == 1)}.items()])
    done = sums.select("k", "threshold", "tp", "fp", "tn", "fn", *rates())
    if max_fpr is not None:
        done = done.where(F.col("fpr") <= max_fpr)
    return done.orderBy(F.desc("accuracy"), "fpr", F.desc("f1"), F.desc("precision"), F.desc("recall"), "k").limit(1)


def calibrate(scored: DataFrame, label: str, prob: str = "prob") -> DataFrame:
    """Isotonic calibration: ``prob`` mapped to ``calibrated``."""
    from pyspark.ml.regression import IsotonicRegression

    fitted = IsotonicRegression(featuresCol=prob, labelCol=label).fit(scored.withColumn(label, F.col(label).cast("double")))
    return fitted.transform(scored).withColumnRenamed("prediction", "calibrated")


def principal_components(df: DataFrame, key: str, features: list[str], k: int) -> DataFrame:
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import PCA, Imputer, StandardScaler, VectorAssembler
    from pyspark.ml.functions import vector_to_array

    filled = [f"{f}_f" for f in features]
    steps = [Imputer(strategy="median", inputCols=features, outputCols=filled), VectorAssembler(inputCols=filled, outputCol="v"), StandardScaler(inputCol="v", outputCol="z", withMean=True), PCA(k=k, inputCol="z", outputCol="pc")]
    done = Pipeline(stages=steps).fit(df).transform(df)
    pc = vector_to_array("pc")
    return done.select(key, *[pc[i].alias(f"pc{i + 1}") for i in range(k)])
