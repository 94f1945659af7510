"""Queries: confusion, summaries, robust statistics, AUC, drift, proxies and search tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from kymo.functions import exprs
from kymo.operators import metrics
from kymo.operators.series import runs
from kymo.plans.base import E_SQL, L_SQL, LF_SQL, W_SQL, event_windows, events, line_features, lines, query
from kymo.sources.tables import table

_COUNTS = "count(*) FILTER (WHERE label=1 AND pred=1) AS tp, count(*) FILTER (WHERE label=0 AND pred=1) AS fp, count(*) FILTER (WHERE label=0 AND pred=0) AS tn, count(*) FILTER (WHERE label=1 AND pred=0) AS fn"
_RATES = """round(coalesce((tp+tn)/nullif(tp+fp+tn+fn,0),0),6) AS accuracy, round(coalesce(tp/nullif(tp+fp,0),0),6) AS "precision", round(coalesce(tp/nullif(tp+fn,0),0),6) AS recall,
 round(coalesce(2*tp/nullif(2*tp+fp+fn,0),0),6) AS f1, round(coalesce(fp/nullif(fp+tn,0),0),6) AS fpr, round(coalesce(fn/nullif(fn+tp,0),0),6) AS fnr"""


@query(f"""WITH {W_SQL}, s AS (SELECT *, 'split' AS dimension, split AS stratum FROM w UNION ALL SELECT *, 'time', CASE WHEN wid<2 THEN 'early' ELSE 'late' END FROM w),
 g AS (SELECT dimension, stratum, {_COUNTS}, count(DISTINCT user_id) AS n_samples FROM s GROUP BY 1, 2) SELECT *, {_RATES}, CASE WHEN n_samples<30 THEN 1 ELSE 0 END AS low_support FROM g""")
def confusion_by_stratum(spark, sf_dir):
    w = event_windows(spark, sf_dir).withColumn("time", F.when(F.col("wid") < 2, "early").otherwise("late"))
    return metrics.strata(w, ["split", "time"], "label", "pred", "user_id", 30)


@query(f"WITH {L_SQL} SELECT coalesce(split, 'all') AS split, coalesce(label, -1) AS label, count(*) AS n, grouping(split) AS g_split, grouping(label) AS g_label FROM l GROUP BY ROLLUP(split, label)")
def metrics_rollup_split_label(spark, sf_dir):
    r = lines(spark, sf_dir).rollup("split", "label").agg(F.count(F.lit(1)).alias("n"), F.grouping("split").cast("long").alias("g_split"), F.grouping("label").cast("long").alias("g_label"))
    return r.select(F.coalesce("split", F.lit("all")).alias("split"), F.coalesce("label", F.lit(-1)).alias("label"), "n", "g_split", "g_label")


@query(f"WITH {W_SQL}, g AS (SELECT split, user_id, avg(CASE WHEN label=pred THEN 1.0 ELSE 0.0 END) AS acc FROM w GROUP BY 1, 2) SELECT split, count(*) AS n_groups, round(avg(acc),6) AS mean, round(coalesce(stddev_samp(acc),0),6) AS std, round(min(acc),6) AS worst, round(max(acc),6) AS best FROM g GROUP BY 1")
def group_accuracy_dispersion(spark, sf_dir):
    g = event_windows(spark, sf_dir).groupBy("split", "user_id").agg(F.avg((F.col("label") == F.col("pred")).cast("double")).alias("acc"))
    return g.groupBy("split").agg(F.count(F.lit(1)).alias("n_groups"), F.round(F.avg("acc"), 6).alias("mean"), F.round(F.coalesce(F.stddev_samp("acc"), F.lit(0.0)), 6).alias("std"), F.round(F.min("acc"), 6).alias("worst"), F.round(F.max("acc"), 6).alias("best"))


@query(f"""WITH {W_SQL}, u AS (SELECT DISTINCT user_id FROM e) SELECT u.user_id, count(w.wid) AS n_windows, round(avg(w.prob),6) AS prob_mean, round(min(w.prob),6) AS prob_min, round(max(w.prob),6) AS prob_max, round(coalesce(stddev_pop(w.prob),0),6) AS prob_std,
 coalesce(sum(w.pred),0)::BIGINT AS n_positive, count(*) FILTER (WHERE w.label=1 AND w.pred=1) AS tp, count(*) FILTER (WHERE w.label=0 AND w.pred=1) AS fp, count(*) FILTER (WHERE w.label=0 AND w.pred=0) AS tn, count(*) FILTER (WHERE w.label=1 AND w.pred=0) AS fn,
 CASE WHEN count(w.wid)=0 THEN 1 ELSE 0 END AS fallback, CASE WHEN coalesce(avg(w.prob),0)>=0.5 THEN 1 ELSE 0 END AS sample_pred FROM u LEFT JOIN w ON w.user_id=u.user_id GROUP BY 1""")
def sample_inference_summary(spark, sf_dir):
    """Per-sample inference summary; samples without a full window stay, marked as fallback."""
    e = events(spark, sf_dir)
    w = event_windows(spark, sf_dir).withColumnRenamed("user_id", "u")
    j = e.select("user_id").distinct().join(w, F.col("u") == F.col("user_id"), "left")
    kind = F.when(F.col("wid").isNotNull(), exprs.error_type(F.col("label"), F.col("pred")))
    return j.groupBy("user_id").agg(
        F.count("wid").alias("n_windows"), F.round(F.avg("prob"), 6).alias("prob_mean"), F.round(F.min("prob"), 6).alias("prob_min"), F.round(F.max("prob"), 6).alias("prob_max"), F.round(F.coalesce(F.stddev_pop("prob"), F.lit(0.0)), 6).alias("prob_std"),
        F.coalesce(F.sum("pred"), F.lit(0)).cast("long").alias("n_positive"), *[F.count(F.when(kind == k.upper(), 1)).alias(k) for k in ("tp", "fp", "tn", "fn")],
        (F.count("wid") == 0).cast("int").alias("fallback"), (F.coalesce(F.avg("prob"), F.lit(0.0)) >= 0.5).cast("int").alias("sample_pred"),
    )


@query(f"WITH {W_SQL} SELECT user_id, CASE WHEN avg(prob)>=0.45 THEN 1 ELSE 0 END AS by_mean, CASE WHEN avg(pred)>=0.5 THEN 1 ELSE 0 END AS by_vote, max(pred) AS by_any, arg_max(pred, wid) AS by_last FROM w GROUP BY 1")
def sample_votes(spark, sf_dir):
    return event_windows(spark, sf_dir).groupBy("user_id").agg((F.avg("prob") >= 0.45).cast("int").alias("by_mean"), (F.avg("pred") >= 0.5).cast("int").alias("by_vote"), F.max("pred").alias("by_any"), F.max_by("pred", "wid").alias("by_last"))


@query(f"WITH {W_SQL}, s AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY wid) AS r FROM w), g AS (SELECT split, {_COUNTS} FROM s WHERE r>2 GROUP BY 1) SELECT *, {_RATES} FROM g")
def stream_metrics_warmup(spark, sf_dir):
    """Stream metrics: each sample's first windows are not judged."""
    r = F.row_number().over(Window.partitionBy("user_id").orderBy("wid"))
    w = event_windows(spark, sf_dir).withColumn("r", r).where("r > 2")
    return w.groupBy("split").agg(*exprs.confusion(F.col("label"), F.col("pred"))).select("*", *exprs.rates())


@query(f"WITH {LF_SQL} SELECT feature, quantile_cont(value,0.5) AS median, mad(value) AS mad, round(quantile_cont(value,0.75)-quantile_cont(value,0.25),6) AS iqr, round((quantile_cont(value,0.95)-quantile_cont(value,0.05))/abs(quantile_cont(value,0.5)),6) AS range_ratio, round(greatest(-1,least(1,(quantile_cont(value,0.9)+quantile_cont(value,0.1)-2*quantile_cont(value,0.5))/(quantile_cont(value,0.9)-quantile_cont(value,0.1)))),6)+0.0::DOUBLE AS quantile_skew FROM lf GROUP BY 1")
def robust_stats(spark, sf_dir):
    """Exact quantiles and the median absolute deviation in two passes."""
    x = line_features(spark, sf_dir)
    q = x.groupBy("feature").agg(F.percentile("value", F.array(*map(F.lit, (0.05, 0.1, 0.25, 0.5, 0.75, 0.9, 0.95)))).alias("q"))
    mad = x.join(q, "feature").groupBy("feature").agg(F.percentile(F.abs(F.col("value") - F.col("q")[3]), F.lit(0.5)).alias("mad"), F.first("q").alias("q"))
    c = F.col("q")
    skew = F.greatest(F.lit(-1.0), F.least(F.lit(1.0), exprs.safe_div(c[5] + c[1] - 2 * c[3], c[5] - c[1])))
    return mad.select("feature", c[3].alias("median"), "mad", F.round(c[4] - c[2], 6).alias("iqr"), F.round((c[6] - c[0]) / F.abs(c[3]), 6).alias("range_ratio"), (F.round(skew, 6) + F.lit(0.0)).alias("quantile_skew"))


@query(f"WITH {LF_SQL} SELECT feature, split, round(avg(value),6) AS mean, round(stddev_pop(value),6) AS std, round(kurtosis_pop(value)+3,4) AS kurtosis FROM lf GROUP BY 1, 2")
def moments(spark, sf_dir):
    return line_features(spark, sf_dir).groupBy("feature", "split").agg(F.round(F.avg("value"), 6).alias("mean"), F.round(F.stddev_pop("value"), 6).alias("std"), F.round(F.kurtosis("value") + 3, 4).alias("kurtosis"))


@query(f"""WITH {LF_SQL}, q AS (SELECT feature, quantile_cont(value,0.05) AS lo, quantile_cont(value,0.95) AS hi FROM lf WHERE split='train' GROUP BY 1),
 s AS (SELECT l_suppkey, avg(CASE WHEN value<lo OR value>hi THEN 1.0 ELSE 0.0 END) AS ood FROM lf JOIN q USING (feature) WHERE split<>'train' GROUP BY 1) SELECT l_suppkey, round(ood,6) AS ood, CASE WHEN ood>0.12 THEN 1 ELSE 0 END AS alert FROM s""")
def ood_quantile_monitor(spark, sf_dir):
    """Share of values outside the training quantiles, per entity."""
    x = line_features(spark, sf_dir)
    q = x.where("split = 'train'").groupBy(F.col("feature").alias("f")).agg(F.percentile("value", F.array(F.lit(0.05), F.lit(0.95))).alias("q"))
    out = x.where("split <> 'train'").join(q, F.col("f") == F.col("feature"))
    s = out.groupBy("l_suppkey").agg(F.avg(((F.col("value") < F.col("q")[0]) | (F.col("value") > F.col("q")[1])).cast("double")).alias("ood"))
    return s.select("l_suppkey", F.round("ood", 6).alias("ood"), (F.col("ood") > 0.12).cast("int").alias("alert"))


@query(f"""WITH {LF_SQL}, x AS (SELECT * FROM lf WHERE split<>'test'), q AS (SELECT feature, [{', '.join(f'quantile_cont(value,{j/10})' for j in range(1, 10))}] AS q FROM x WHERE split='train' GROUP BY 1),
 b AS (SELECT x.feature, len(list_filter(q.q, lambda z: z<=x.value)) AS bin, split FROM x JOIN q USING (feature)), c AS (SELECT feature, bin, count(*) FILTER (WHERE split='train') AS a, count(*) FILTER (WHERE split='valid') AS b FROM b GROUP BY 1, 2),
 f AS (SELECT g.feature, g.bin, coalesce(a,0) AS a, coalesce(b,0) AS b FROM (SELECT feature, unnest(range(10)) AS bin FROM q) g LEFT JOIN c ON c.feature=g.feature AND c.bin=g.bin),
 p AS (SELECT feature, greatest(a/sum(a) OVER (PARTITION BY feature),1e-6) AS p, greatest(b/sum(b) OVER (PARTITION BY feature),1e-6) AS r FROM f) SELECT feature, round(sum((r-p)*ln(r/p)),8) AS psi FROM p GROUP BY 1""")
def drift_psi(spark, sf_dir):
    x = line_features(spark, sf_dir).where("split <> 'test'")
    return metrics.psi(x, "feature", "value", F.col("split") == "train").select("feature", F.round("psi", 8).alias("psi"))


@query(f"""WITH {LF_SQL}, c AS (SELECT feature, value, count(*) FILTER (WHERE split='train') AS a, count(*) FILTER (WHERE split='valid') AS b FROM lf WHERE split<>'test' GROUP BY 1, 2),
 d AS (SELECT feature, abs(sum(a) OVER w/sum(a) OVER (PARTITION BY feature)-sum(b) OVER w/sum(b) OVER (PARTITION BY feature)) AS d FROM c WINDOW w AS (PARTITION BY feature ORDER BY value)) SELECT feature, round(max(d),9) AS ks FROM d GROUP BY 1""")
def drift_ks(spark, sf_dir):
    x = line_features(spark, sf_dir).where("split <> 'test'")
    return metrics.ks_statistic(x, "feature", "value", F.col("split") == "train").select("feature", F.round("ks", 9).alias("ks"))


@query(f"WITH {LF_SQL}, g AS (SELECT feature, avg(value) FILTER (WHERE split='train') AS m, stddev_pop(value) FILTER (WHERE split='train') AS s, avg(value) FILTER (WHERE split='valid') AS m2, stddev_pop(value) FILTER (WHERE split='valid') AS s2 FROM lf GROUP BY 1) SELECT feature, round(abs(m2-m)/s,6) AS mean_shift, round(s2/s,6) AS std_ratio FROM g")
def drift_mean_shift(spark, sf_dir):
    t, v = F.when(F.col("split") == "train", F.col("value")), F.when(F.col("split") == "valid", F.col("value"))
    g = line_features(spark, sf_dir).groupBy("feature").agg(F.avg(t).alias("m"), F.stddev_pop(t).alias("s"), F.avg(v).alias("m2"), F.stddev_pop(v).alias("s2"))
    return g.select("feature", F.round(F.try_divide(F.abs(F.col("m2") - F.col("m")), F.col("s")), 6).alias("mean_shift"), F.round(F.try_divide(F.col("s2"), F.col("s")), 6).alias("std_ratio"))


_AUC = "(sum(r) FILTER (WHERE label=1)-sum(label)*(sum(label)+1)/2.0::DOUBLE)/(sum(label)*(count(*)-sum(label)))"


@query(f"WITH {LF_SQL}, k AS (SELECT *, rank() OVER (PARTITION BY feature ORDER BY value)+(count(*) OVER (PARTITION BY feature, value)-1)/2.0::DOUBLE AS r FROM lf), a AS (SELECT feature, {_AUC} AS auc FROM k GROUP BY 1) SELECT feature, round(auc,9) AS auc, round(2*abs(auc-0.5),9) AS separation FROM a")
def auc_by_feature(spark, sf_dir):
    a = metrics.rank_auc(line_features(spark, sf_dir), ["feature"], "value", "label")
    return a.select("feature", F.round("auc", 9).alias("auc"), F.round(2 * F.abs(F.col("auc") - 0.5), 9).alias("separation"))


@query(f"WITH {LF_SQL}, k AS (SELECT *, rank() OVER (PARTITION BY feature, split ORDER BY value)+(count(*) OVER (PARTITION BY feature, split, value)-1)/2.0::DOUBLE AS r FROM lf), a AS (SELECT feature, split, {_AUC} AS auc FROM k GROUP BY 1, 2) SELECT feature, round(max(auc) FILTER (WHERE split='train'),9) AS train, round(max(auc) FILTER (WHERE split='valid'),9) AS valid, round(max(auc) FILTER (WHERE split='test'),9) AS test FROM a GROUP BY 1")
def auc_split_pivot(spark, sf_dir):
    a = metrics.rank_auc(line_features(spark, sf_dir), ["feature", "split"], "value", "label")
    return a.groupBy("feature").pivot("split", ["train", "valid", "test"]).agg(F.round(F.first("auc"), 9))


@query(f"""WITH {E_SQL}, t AS (SELECT quantile_cont(value, 0.05) AS thr FROM e WHERE label=1), h AS (SELECT e.*, value>=thr AS hit, row_number() OVER (PARTITION BY user_id ORDER BY i) AS n FROM e, t WHERE label=0),
 g AS (SELECT user_id, hit, n-row_number() OVER (PARTITION BY user_id, hit ORDER BY i) AS g FROM h), r AS (SELECT user_id, count(*) AS run FROM g WHERE hit GROUP BY user_id, g.g)
 SELECT u.user_id, coalesce(max(run),0) AS longest, CASE WHEN coalesce(max(run),0)>=1 THEN 1 ELSE 0 END AS any_fp, CASE WHEN coalesce(max(run),0)>=3 THEN 1 ELSE 0 END AS state_fp FROM (SELECT DISTINCT user_id FROM h) u LEFT JOIN r USING (user_id) GROUP BY 1""")
def fp_proxy_runs(spark, sf_dir):
    """False-positive proxy: threshold at the 5th percentile of positives; any hit, and three in a row, among negatives."""
    e = events(spark, sf_dir)
    thr = e.where("label = 1").agg(F.percentile("value", F.lit(0.05)).alias("t")).first()["t"]
    neg = e.where("label = 0")
    r = runs(neg, "user_id", ["i"], F.col("value") >= thr).withColumnRenamed("user_id", "u")
    j = neg.select("user_id").distinct().join(r, F.col("u") == F.col("user_id"), "left")
    longest = F.coalesce(F.max("run"), F.lit(0))
    return j.groupBy("user_id").agg(longest.alias("longest"), (longest >= 1).cast("int").alias("any_fp"), (longest >= 3).cast("int").alias("state_fp"))


@query(f"""WITH {LF_SQL}, x AS (SELECT feature, split, label, CASE WHEN l_orderkey%13=0 AND feature='tax' THEN NULL ELSE value END AS value FROM lf),
 k AS (SELECT *, rank() OVER (PARTITION BY feature ORDER BY value)+(count(*) OVER (PARTITION BY feature, value)-1)/2.0::DOUBLE AS r FROM x WHERE split='train' AND value IS NOT NULL), a AS (SELECT feature, {_AUC} AS auc FROM k GROUP BY 1),
 m AS (SELECT feature, avg(CASE WHEN value IS NULL THEN 1.0 ELSE 0.0 END) AS missing, var_samp(value) AS variance FROM x WHERE split='train' GROUP BY 1)
 SELECT feature, round(missing,6) AS missing_rate, round(variance,4) AS variance, round(greatest(auc,1-auc),9) AS auc, CASE WHEN missing>0.05 THEN 'missing' WHEN variance<=0.001 THEN 'variance' ELSE 'kept' END AS verdict FROM m JOIN a USING (feature)""")
def feature_diagnostics_long(spark, sf_dir):
    x = line_features(spark, sf_dir).where("split = 'train'").withColumn("value", F.when((F.col("l_orderkey") % 13 != 0) | (F.col("feature") != "tax"), F.col("value")))
    m = x.groupBy("feature").agg(F.avg(F.col("value").isNull().cast("double")).alias("missing"), F.var_samp("value").alias("variance"))
    a = metrics.rank_auc(x, ["feature"], "value", "label").select("feature", "auc")
    verdict = F.when(F.col("missing") > 0.05, "missing").when(F.col("variance") <= 0.001, "variance").otherwise("kept")
    return m.join(a, "feature").select("feature", F.round("missing", 6).alias("missing_rate"), F.round("variance", 4).alias("variance"), F.round(F.greatest(F.col("auc"), 1 - F.col("auc")), 9).alias("auc"), verdict.alias("verdict"))


_FOLDS = "f AS (SELECT l_linenumber%3 AS candidate, (l_orderkey*2654435761)%4294967296%3 AS fold, (l_orderkey*2654435761)%4294967296%2 AS repeat, CASE WHEN (l_quantity>25)=(l_returnflag='R') THEN 1.0 ELSE 0.0 END AS ok FROM lineitem)"


@query(f"WITH {_FOLDS}, g AS (SELECT candidate, repeat, fold, avg(ok) AS acc FROM f GROUP BY 1,2,3), r AS (SELECT candidate, repeat, avg(acc) AS m FROM g GROUP BY 1,2), c AS (SELECT candidate, avg(acc) AS m, stddev_pop(acc) AS s FROM g GROUP BY 1) SELECT c.candidate, round(c.m,6) AS mean, round(c.s,6) AS std, round(min(r.m),6) AS worst_repeat, round(max(r.m),6) AS best_repeat FROM c JOIN r USING (candidate) GROUP BY 1, 2, 3")
def cv_fold_summary(spark, sf_dir):
    """Cross-validation: folds, then repeats, then candidates; folds by a hash of the group."""
    h = exprs.mult_hash(F.col("l_orderkey"))
    x = table(spark, sf_dir, "lineitem").select((F.col("l_linenumber") % 3).alias("candidate"), (h % 3).alias("fold"), (h % 2).alias("repeat"), ((F.col("l_quantity") > 25) == (F.col("l_returnflag") == "R")).cast("double").alias("ok"))
    g = x.groupBy("candidate", "repeat", "fold").agg(F.avg("ok").alias("acc"))
    r = g.groupBy("candidate", "repeat").agg(F.avg("acc").alias("m"), F.collect_list("acc").alias("accs"))
    c = r.groupBy("candidate").agg(F.flatten(F.collect_list("accs")).alias("a"), F.min("m").alias("lo"), F.max("m").alias("hi"))
    n = F.size("a")
    mean = F.aggregate("a", F.lit(0.0), lambda s, v: s + v) / n
    var = F.aggregate("a", F.lit(0.0), lambda s, v: s + v * v) / n - mean * mean
    return c.select("candidate", F.round(mean, 6).alias("mean"), F.round(F.sqrt(F.greatest(var, F.lit(0.0))), 6).alias("std"), F.round("lo", 6).alias("worst_repeat"), F.round("hi", 6).alias("best_repeat"))


@query("WITH c AS (SELECT l_suppkey AS candidate, round(avg(CASE WHEN l_returnflag='R' THEN 1.0 ELSE 0.0 END),6) AS acc FROM lineitem GROUP BY 1), r AS (SELECT *, row_number() OVER (ORDER BY acc DESC, candidate) AS r FROM c) SELECT round(max(acc) FILTER (WHERE r=1)-max(acc) FILTER (WHERE r=2),6) AS top_margin, count(*) FILTER (WHERE acc >= (SELECT max(acc) FROM c)-0.02) AS close, min(r) FILTER (WHERE candidate=7) AS default_rank FROM r")
def search_stability(spark, sf_dir):
    """Margin of the best candidate, candidates close to it, rank of the default."""
    c = table(spark, sf_dir, "lineitem").groupBy(F.col("l_suppkey").alias("candidate")).agg(F.round(F.avg((F.col("l_returnflag") == "R").cast("double")), 6).alias("acc"))
    w = Window.orderBy(F.desc("acc"), "candidate")  # a table of candidates
    r = c.withColumn("r", F.row_number().over(w)).withColumn("top", F.max("acc").over(Window.partitionBy()))
    return r.agg(F.round(F.max(F.when(F.col("r") == 1, F.col("acc"))) - F.max(F.when(F.col("r") == 2, F.col("acc"))), 6).alias("top_margin"), F.count(F.when(F.col("acc") >= F.col("top") - 0.02, 1)).alias("close"), F.min(F.when(F.col("candidate") == 7, F.col("r"))).cast("long").alias("default_rank"))


@query("SELECT p_brand, count(DISTINCT p_type) AS n_sources, count(*) FILTER (WHERE p_size>45) AS n_forbidden, round(avg(p_retailprice),6) AS mean_cost FROM part GROUP BY 1")
def cost_summary(spark, sf_dir):
    return table(spark, sf_dir, "part").groupBy("p_brand").agg(F.countDistinct("p_type").alias("n_sources"), F.count(F.when(F.col("p_size") > 45, 1)).alias("n_forbidden"), F.round(F.avg("p_retailprice"), 6).alias("mean_cost"))


@query("SELECT user_id, count(*) FILTER (WHERE event_id%11=0) AS n_invalid, count(*) AS n FROM events GROUP BY 1")
def invalid_counts(spark, sf_dir):
    v = F.when(F.col("event_id") % 11 == 0, F.lit(float("nan"))).otherwise(F.col("value"))
    return table(spark, sf_dir, "events").groupBy("user_id").agg(F.count(F.when(~exprs.is_finite(v), 1)).alias("n_invalid"), F.count(F.lit(1)).alias("n"))


@query(f"""WITH {E_SQL}, t AS (SELECT i AS k, CASE WHEN i=180 THEN 0.95::DOUBLE ELSE i*((0.95::DOUBLE-0.05::DOUBLE)/180)+0.05::DOUBLE END AS threshold FROM range(181) r(i)),
 c AS (SELECT k, threshold, count(*) FILTER (WHERE prob>=threshold AND label=1) AS tp, count(*) FILTER (WHERE prob>=threshold AND label=0) AS fp, count(*) FILTER (WHERE prob<threshold AND label=0) AS tn, count(*) FILTER (WHERE prob<threshold AND label=1) AS fn FROM e, t GROUP BY 1, 2) SELECT k, threshold, tp, fp, tn, fn, {_RATES} FROM c""")
def threshold_sweep_181(spark, sf_dir):
    """All thresholds from one pass: counts per threshold cell, then suffix sums over 181 rows."""
    grid = exprs.threshold_grid(spark)
    e = events(spark, sf_dir)
    thresholds = [r["threshold"] for r in grid.orderBy("k").collect()]  # 181 constants
    at = F.aggregate(F.array(*map(F.lit, thresholds)), F.lit(-1), lambda a, t: a + F.when(t <= F.col("prob"), 1).otherwise(0))
    cells = e.groupBy(at.cast("long").alias("c")).agg(F.sum("label").alias("p"), F.sum(1 - F.col("label")).alias("n"))
    all_ = spark.range(-1, 181).select(F.col("id").alias("c")).join(cells, "c", "left").fillna(0)
    up, whole = Window.orderBy("c").rowsBetween(0, Window.unboundedFollowing), Window.partitionBy()
    x = all_.select("c", F.sum("p").over(up).alias("tp"), F.sum("n").over(up).alias("fp"), F.sum("p").over(whole).alias("P"), F.sum("n").over(whole).alias("N")).where("c >= 0")
    x = x.select(F.col("c").alias("k"), "tp", "fp", (F.col("N") - F.col("fp")).alias("tn"), (F.col("P") - F.col("tp")).alias("fn"))
    return grid.join(x, "k").select("k", "threshold", "tp", "fp", "tn", "fn", *exprs.rates())


@query(f"WITH {E_SQL}, c AS (SELECT round(prob,3) AS score, sum(label) AS p, count(*)-sum(label) AS n FROM e GROUP BY 1) SELECT score, round(sum(p) OVER w/sum(p) OVER (),9) AS tpr, round(sum(n) OVER w/sum(n) OVER (),9) AS fpr FROM c WINDOW w AS (ORDER BY score DESC)")
def roc_points(spark, sf_dir):
    c = events(spark, sf_dir).groupBy(F.round("prob", 3).alias("score")).agg(F.sum("label").alias("p"), F.sum(1 - F.col("label")).alias("n"))
    w, whole = Window.orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, 0), Window.partitionBy()
    return c.select("score", F.round(F.sum("p").over(w) / F.sum("p").over(whole), 9).alias("tpr"), F.round(F.sum("n").over(w) / F.sum("n").over(whole), 9).alias("fpr"))


@query(f"WITH {E_SQL}, q AS (SELECT quantile_cont(prob,0.9) AS cut FROM e WHERE split='train' AND label=0) SELECT event_id, CASE WHEN label=0 AND (prob>=0.85 OR prob>=cut) THEN 3.0::DOUBLE ELSE 1.0::DOUBLE END AS weight FROM e, q WHERE split='train'")
def hard_negative_weights(spark, sf_dir):
    e = events(spark, sf_dir).where("split = 'train'")
    cut_ = e.where("label = 0").agg(F.percentile("prob", F.lit(0.9)).alias("c")).first()["c"]
    hard = (F.col("label") == 0) & ((F.col("prob") >= 0.85) | (F.col("prob") >= cut_))
    return e.select("event_id", F.when(hard, 3.0).otherwise(1.0).alias("weight"))


@query(f"WITH {W_SQL}, a AS (SELECT split, avg(prob) AS m FROM w GROUP BY 1) SELECT 'rate' AS section, split AS item, CASE WHEN m<=0.6 THEN 1 ELSE 0 END AS passed FROM a UNION ALL SELECT 'all', 'every', CASE WHEN bool_and(m<=0.6) THEN 1 ELSE 0 END FROM a")
def acceptance_report(spark, sf_dir):
    """Assertion rows by section, and whether every one passed."""
    a = event_windows(spark, sf_dir).groupBy("split").agg((F.avg("prob") <= 0.6).alias("ok"))
    rows = a.select(F.lit("rate").alias("section"), F.col("split").alias("item"), F.col("ok").cast("int").alias("passed"))
    return rows.unionByName(a.agg(F.every("ok").cast("int").alias("passed")).select(F.lit("all").alias("section"), F.lit("every").alias("item"), "passed"))


@query(f"WITH {W_SQL}, g AS (SELECT user_id, {_COUNTS} FROM w GROUP BY 1) SELECT user_id, fp AS evidence, 'review_negatives' AS action FROM g WHERE fp>=5 UNION ALL SELECT user_id, fn, 'lower_threshold' FROM g WHERE fn>=3")
def audit_action_items(spark, sf_dir):
    """Rules over strata, united into a list of actions."""
    g = event_windows(spark, sf_dir).groupBy("user_id").agg(*exprs.confusion(F.col("label"), F.col("pred")))
    a = g.where("fp >= 5").select("user_id", F.col("fp").alias("evidence"), F.lit("review_negatives").alias("action"))
    return a.unionByName(g.where("fn >= 3").select("user_id", F.col("fn").alias("evidence"), F.lit("lower_threshold").alias("action")))


@query(f"WITH {W_SQL} SELECT a.user_id, a.wid, CASE WHEN abs(a.prob-b.prob) <= 1e-6+1e-5*abs(b.prob) THEN 1 ELSE 0 END AS same FROM w a JOIN w b ON a.user_id=b.user_id AND a.wid=b.wid")
def golden_tolerance_join(spark, sf_dir):
    """Golden values against recomputed ones within absolute and relative tolerances."""
    from kymo.session import cut

    w = event_windows(spark, sf_dir).select("user_id", "wid", "prob")
    g = cut(w.withColumnRenamed("prob", "golden"), "golden")
    same = (F.abs(F.col("prob") - F.col("golden")) <= 1e-6 + 1e-5 * F.abs("golden")).cast("int")
    return w.join(g, ["user_id", "wid"]).select("user_id", "wid", same.alias("same"))
