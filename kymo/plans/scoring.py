"""Queries: rankings, threshold objectives, the search over the state machine's parameters, summaries, bins and alignment."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from kymo.functions import exprs
from kymo.operators import metrics, replay, scores
from kymo.operators.series import runs
from kymo.plans.base import E_SQL, L_SQL, W_SQL, event_windows, events, lines, query
from kymo.sources.tables import table

#: Deployment cost and dependence on scale of the event features.
_COSTS = {"value": (0.4, True), "inverse": (0.8, False), "step": (1.6, True)}
_EF_SQL = E_SQL + """, ef AS (SELECT user_id, i, label, split, unnest(['value', 'inverse', 'step']) AS feature,
  unnest([value, 1/(1+value), value-lag(value, 1, value) OVER (PARTITION BY user_id ORDER BY i)]) AS value FROM e)"""


def _event_features(spark, sf_dir):
    before = F.lag("value").over(Window.partitionBy("user_id").orderBy("i"))
    e = events(spark, sf_dir).withColumn("inverse", 1 / (1 + F.col("value"))).withColumn("step", F.col("value") - F.coalesce(before, F.col("value")))
    return metrics.long_features(e, ["user_id", "i", "label", "split"], list(_COSTS))


_COST_SQL = "(VALUES " + ", ".join(f"('{f}', {1 - min(c / 4, 1) * 0.45 - (0.25 if s else 0.0)}::DOUBLE)" for f, (c, s) in _COSTS.items()) + ") c(feature, deployment_fit)"


@query(f"""WITH {_EF_SQL}, t AS (SELECT *, (user_id*2654435761)%4294967296%5 AS fold FROM ef WHERE split='train'),
 k AS (SELECT *, rank() OVER (PARTITION BY feature, fold ORDER BY value)+(count(*) OVER (PARTITION BY feature, fold, value)-1)/2.0::DOUBLE AS r FROM t),
 a AS (SELECT feature, fold, (sum(r) FILTER (WHERE label=1)-sum(label)*(sum(label)+1)/2.0::DOUBLE)/(sum(label)*(count(*)-sum(label))) AS auc FROM k GROUP BY 1, 2),
 s AS (SELECT feature, avg(2*abs(auc-0.5)) AS mean_separation, min(2*abs(auc-0.5)) AS min_separation FROM a GROUP BY 1),
 m AS (SELECT feature, CASE WHEN median(value) FILTER (WHERE label=1) >= median(value) FILTER (WHERE label=0) THEN 1 ELSE -1 END AS d FROM t GROUP BY 1),
 q AS (SELECT t.feature, quantile_cont(value*d, 0.05) FILTER (WHERE label=1) AS thr FROM t JOIN m USING (feature) GROUP BY 1),
 n AS (SELECT t.feature, user_id, i, value*d >= thr AS hit, row_number() OVER (PARTITION BY t.feature, user_id ORDER BY i) AS p FROM t JOIN m USING (feature) JOIN q ON q.feature=t.feature WHERE label=0),
 g AS (SELECT *, p-row_number() OVER (PARTITION BY feature, user_id, hit ORDER BY i) AS g FROM n), r AS (SELECT feature, user_id, count(*) AS run FROM g WHERE hit GROUP BY feature, user_id, g),
 u AS (SELECT n.feature, n.user_id, coalesce((SELECT max(run) FROM r WHERE r.feature=n.feature AND r.user_id=n.user_id), 0) AS longest FROM (SELECT DISTINCT feature, user_id FROM n) n),
 f AS (SELECT feature, 1-0.5*avg(CASE WHEN longest>=1 THEN 1.0 ELSE 0.0 END)-0.5*avg(CASE WHEN longest>=3 THEN 1.0 ELSE 0.0 END) AS fp_fit FROM u GROUP BY 1),
 z AS (SELECT feature, mean_separation, min_separation, fp_fit, deployment_fit, 0.45*mean_separation+0.25*min_separation+0.20*fp_fit+0.10*deployment_fit AS score FROM s JOIN f USING (feature) JOIN {_COST_SQL} USING (feature))
 SELECT feature, round(mean_separation,6) AS mean_separation, round(min_separation,6) AS min_separation, round(fp_fit,6) AS fp_fit, round(deployment_fit,6) AS deployment_fit, round(score,6) AS ranking_score,
  round(0.75*score+0.25*deployment_fit,6) AS deployment_score, row_number() OVER (ORDER BY round(score,9) DESC, feature) AS rank FROM z""")
def feature_ranking(spark, sf_dir):
    """Governed ranking: separation over group folds, false-positive proxy, deployment fit, and their blend."""
    t = _event_features(spark, sf_dir).where("split = 'train'").withColumn("fold", exprs.mult_hash(F.col("user_id")) % 5)
    a = metrics.rank_auc(t, ["feature", "fold"], "value", "label").withColumn("s", 2 * F.abs(F.col("auc") - 0.5))
    s = a.groupBy("feature").agg(F.avg("s").alias("mean_separation"), F.min("s").alias("min_separation"))
    of = lambda y: F.percentile(F.when(F.col("label") == y, F.col("value")), F.lit(0.5))
    t = t.join(t.groupBy("feature").agg(F.when(of(1) >= of(0), 1.0).otherwise(-1.0).alias("d")), "feature").withColumn("v", F.col("value") * F.col("d"))
    thr = t.where("label = 1").groupBy("feature").agg(F.percentile("v", F.lit(0.05)).alias("thr"))
    negatives = t.where("label = 0").join(thr, "feature").withColumn("who", F.struct("feature", "user_id"))
    r = runs(negatives, "who", ["i"], F.col("v") >= F.col("thr")).groupBy("who").agg(F.max("run").alias("longest"))
    u = negatives.select("who").distinct().join(r, "who", "left").select("who.feature", F.coalesce("longest", F.lit(0)).alias("longest"))
    f = u.groupBy("feature").agg((1 - 0.5 * F.avg((F.col("longest") >= 1).cast("double")) - 0.5 * F.avg((F.col("longest") >= 3).cast("double"))).alias("fp_fit"))
    costs = spark.createDataFrame([(n, c, d) for n, (c, d) in _COSTS.items()], "feature string, cost double, scale boolean")
    costs = costs.select("feature", scores.deployment_fit(F.col("feature"), F.col("cost"), F.col("scale")).alias("deployment_fit"))
    z = s.join(f, "feature").join(costs, "feature").withColumn("score", scores.ranking())
    place = F.row_number().over(Window.orderBy(F.round("score", 9).desc(), "feature")).cast("long")  # one row a feature
    rounded = [F.round(c, 6).alias(c) for c in scores.RANKING]
    return z.select("feature", *rounded, F.round("score", 6).alias("ranking_score"), F.round(scores.blended(F.col("score"), F.col("deployment_fit")), 6).alias("deployment_score"), place.alias("rank"))


_CURVE = f"""{E_SQL}, t AS (SELECT i AS k, CASE WHEN i=180 THEN 0.95::DOUBLE ELSE i*((0.95::DOUBLE-0.05::DOUBLE)/180)+0.05::DOUBLE END AS threshold FROM range(181) r(i)),
 c AS (SELECT k, threshold, count(*) FILTER (WHERE prob>=threshold AND label=1) AS tp, count(*) FILTER (WHERE prob>=threshold AND label=0) AS fp, count(*) FILTER (WHERE prob<threshold AND label=0) AS tn, count(*) FILTER (WHERE prob<threshold AND label=1) AS fn FROM e, t GROUP BY 1, 2),
 x AS (SELECT k, threshold, coalesce((tp+tn)/nullif(tp+fp+tn+fn,0),0) AS accuracy, coalesce(tp/nullif(tp+fp,0),0) AS p, coalesce(tp/nullif(tp+fn,0),0) AS r, coalesce(2*tp/nullif(2*tp+fp+fn,0),0) AS f1, coalesce(fp/nullif(fp+tn,0),0) AS fpr FROM c),
 y AS (SELECT *, CASE WHEN 0.25*p+r>0 THEN 1.25*p*r/(0.25*p+r) ELSE 0 END AS fbeta, CASE WHEN p>=0.95 THEN r ELSE p-1.0 END AS constrained FROM x)"""


def _chosen(objective: str, keys: tuple[str, ...]) -> str:
    name = {"precision": "p", "recall": "r"}
    order = ", ".join(f"{name.get(k, k)} DESC" if not k.startswith("-") else f"{k[1:]} ASC" for k in keys)
    return f"(SELECT '{objective}' AS objective, k, threshold, round({name.get(keys[0], keys[0])}, 9) AS score FROM y ORDER BY {order}, k LIMIT 1)"


@query(f"WITH {_CURVE} " + " UNION ALL ".join(_chosen(o, k) for o, k in scores.OBJECTIVES.items()))
def threshold_objectives(spark, sf_dir):
    """The best of 181 thresholds for each of six objectives, from one pass over the scores."""
    curve = metrics.threshold_curve(events(spark, sf_dir), "prob", "label")
    return scores.threshold_choices(curve).select("objective", "k", "threshold", F.round("score", 9).alias("score"))


@query(f"""WITH {L_SQL}, g AS (SELECT l_suppkey AS candidate, avg(CASE WHEN (quantity>25)=(label=1) THEN 1.0 ELSE 0.0 END) AS accuracy, coalesce(count(*) FILTER (WHERE label=0 AND quantity>25)/nullif(count(*) FILTER (WHERE label=0),0),0) AS fpr, count(*) AS nodes FROM l GROUP BY 1)
 SELECT candidate, nodes, CASE WHEN nodes<=620 THEN round(accuracy-2*fpr-0.1*nodes/620.0::DOUBLE,9) END AS score FROM g""")
def model_search_scores(spark, sf_dir):
    """Accuracy less the price of false positives and of size; too large a model has no score."""
    hit = (F.col("quantity") > 25) == (F.col("label") == 1)
    negative = F.col("label") == 0
    fpr = exprs.safe_div(F.count(F.when(negative & (F.col("quantity") > 25), 1)), F.count(F.when(negative, 1)))
    g = lines(spark, sf_dir).groupBy(F.col("l_suppkey").alias("candidate")).agg(F.avg(hit.cast("double")).alias("accuracy"), fpr.alias("fpr"), F.count(F.lit(1)).alias("nodes"))
    return g.select("candidate", "nodes", F.round(scores.model_search(F.col("accuracy"), F.col("fpr"), F.col("nodes"), max_nodes=620), 9).alias("score"))


GRID = replay.within_budget(replay.search_grid(0.5), 240)
_GRID_SQL = ", ".join("({}, {}::DOUBLE, {}, {}::DOUBLE, {}::DOUBLE, {}, {}, {}, {})".format(k, p["alpha"], p["median_k"], p["t_on"], p["t_off"], p["k_on"], p["k_off"], int(p["cooldown"]), replay.STRATEGIES.index(p["strategy"])) for k, p in enumerate(GRID))
_STEP = "g.alpha*x.p+(1-g.alpha)*m.score"
_REPLAY_SQL = f"""{E_SQL}, g(pid, alpha, median_k, t_on, t_off, k_on, k_off, cooldown, strategy) AS (VALUES {_GRID_SQL}),
 u AS (SELECT user_id, CASE WHEN avg(label)>=0.4 THEN 1 ELSE 0 END AS target, count(*) AS n FROM e GROUP BY 1),
 x AS (SELECT user_id, i, label, prob AS p, 1 AS median_k FROM e UNION ALL SELECT user_id, i, label, median(prob) OVER (PARTITION BY user_id ORDER BY i ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 3 FROM e),
 m AS (SELECT pid, user_id, i, p AS score, 0 AS state, CASE WHEN p>t_on THEN 1 ELSE 0 END AS on_n, 0 AS off_n, 1000 AS steps FROM x JOIN g ON g.median_k=x.median_k WHERE i=0
  UNION ALL SELECT pid, user_id, i, score, CASE WHEN flips THEN 1-state ELSE state END, CASE WHEN flips THEN 0 ELSE on_n END, CASE WHEN flips THEN 0 ELSE off_n END, CASE WHEN flips THEN 0 ELSE steps END FROM (
   SELECT *, steps>=cooldown AND CASE WHEN state=0 THEN on_n>=k_on ELSE off_n>=k_off END AS flips FROM (
    SELECT m.pid, m.user_id, x.i, {_STEP} AS score, m.state, g.k_on, g.k_off, g.cooldown, m.steps+1 AS steps,
     CASE WHEN m.state=0 THEN CASE WHEN {_STEP}>g.t_on THEN m.on_n+1 ELSE greatest(m.on_n-1,0) END ELSE m.on_n END AS on_n,
     CASE WHEN m.state=1 THEN CASE WHEN {_STEP}<g.t_off THEN m.off_n+1 ELSE greatest(m.off_n-1,0) END ELSE m.off_n END AS off_n
    FROM m JOIN g ON g.pid=m.pid JOIN x ON x.user_id=m.user_id AND x.i=m.i+1 AND x.median_k=g.median_k))),
 l AS (SELECT m.pid, m.user_id, m.i, m.state, u.target, u.n, e.label, lag(m.state) OVER (PARTITION BY m.pid, m.user_id ORDER BY m.i) AS b FROM m JOIN u ON u.user_id=m.user_id JOIN e ON e.user_id=m.user_id AND e.i=m.i),
 s AS (SELECT l.pid, l.user_id, target, n, sum(state) AS worn, arg_max(state, i) AS final, min(i) FILTER (WHERE state=1) AS first, count(*) FILTER (WHERE state<>b) AS flips, arg_max(state, i) FILTER (WHERE i<8) AS at_eight,
  count(*) FILTER (WHERE state=1 AND label=1) AS w_tp, count(*) FILTER (WHERE state=1 AND label=0) AS w_fp, count(*) FILTER (WHERE state=0 AND label=0) AS w_tn, count(*) FILTER (WHERE state=0 AND label=1) AS w_fn FROM l GROUP BY 1, 2, 3, 4),
 d AS (SELECT s.*, CASE strategy WHEN 0 THEN final WHEN 1 THEN CASE WHEN 2*worn>=n THEN 1 ELSE 0 END ELSE CASE WHEN worn>0 THEN 1 ELSE 0 END END AS pred FROM s JOIN g USING (pid)),
 r AS (SELECT pid, avg(CASE WHEN pred=target THEN 1.0 ELSE 0.0 END) AS sample_accuracy, coalesce(count(*) FILTER (WHERE pred=1 AND target=1)/nullif(count(*) FILTER (WHERE target=1),0),0) AS sample_recall, coalesce(count(*) FILTER (WHERE pred=1 AND target=0)/nullif(count(*) FILTER (WHERE target=0),0),0) AS sample_fp_rate,
  (sum(w_tp)+sum(w_tn))/(sum(w_tp)+sum(w_tn)+sum(w_fp)+sum(w_fn)) AS window_accuracy, coalesce(sum(w_fp)/nullif(sum(w_fp)+sum(w_tn),0),0) AS window_fp_rate, quantile_cont(first::DOUBLE, 0.95) AS first_output_p95_sec, quantile_cont(first::DOUBLE, 0.95) FILTER (WHERE target=1 AND pred=1) AS first_worn_p95_sec,
  avg(CASE WHEN first<8 AND at_eight=target THEN 1.0 ELSE 0.0 END) AS accuracy_at_8s, coalesce(avg(CASE WHEN worn>0 THEN 1.0 ELSE 0.0 END) FILTER (WHERE target=0),0) AS false_worn_event_rate, coalesce(avg(worn) FILTER (WHERE target=0),0) AS false_worn_duration_sec, sum(flips)::BIGINT AS flips FROM d GROUP BY 1)"""


@query(f"""WITH RECURSIVE {_REPLAY_SQL} SELECT pid, flips, round(sample_accuracy,6) AS sample_accuracy, round(sample_recall,6) AS sample_recall, round(sample_fp_rate,6) AS sample_fp_rate, round(window_accuracy,6) AS window_accuracy, round(window_fp_rate,6) AS window_fp_rate,
 round(first_output_p95_sec,6) AS first_output_p95_sec, round(first_worn_p95_sec,6) AS first_worn_p95_sec, round(accuracy_at_8s,6) AS accuracy_at_8s, round(false_worn_event_rate,6) AS false_worn_event_rate, round(false_worn_duration_sec,6) AS false_worn_duration_sec,
 round(sample_accuracy+0.6*sample_recall+0.75*accuracy_at_8s+0.25*window_accuracy-0.1*false_worn_duration_sec-0.3*window_fp_rate-1.5*(sample_fp_rate+false_worn_event_rate)-0.1*first_output_p95_sec/8,6) AS score,
 coalesce(sample_fp_rate<=0.02 AND false_worn_event_rate<=0.02 AND coalesce(first_worn_p95_sec<=3, false) AND accuracy_at_8s>0, false) AS feasible FROM r""")
def postprocess_search(spark, sf_dir):
    """240 of 6,480 parameter points replayed through the machine over every series: metrics, score and constraints of each."""
    e = events(spark, sf_dir)
    targets = e.groupBy(F.col("user_id").alias("u")).agg((F.avg("label") >= 0.4).cast("int").alias("target"))
    rows = e.join(targets, F.col("u") == F.col("user_id")).select("user_id", "target", "i", "prob", "label")
    m = replay.dataset_metrics(replay.replay_table(rows, "user_id", ["i"], "prob", "label", "target", GRID))
    m = m.withColumn("score", scores.postprocess()).withColumn("feasible", scores.satisfies())
    shown = ["sample_accuracy", "sample_recall", "sample_fp_rate", "window_accuracy", "window_fp_rate", "first_output_p95_sec", "first_worn_p95_sec", "accuracy_at_8s", "false_worn_event_rate", "false_worn_duration_sec", "score"]
    return m.select("pid", "flips", *[F.round(c, 6).alias(c) for c in shown], "feasible")


@query(f"""WITH {W_SQL}, q AS (SELECT user_id, wid, prob, (wid*5)::DOUBLE AS start, med/100 AS v, CASE WHEN wid%4=3 THEN NULL ELSE med/200-0.1 END AS share FROM w)
 SELECT user_id, wid, CASE WHEN prob<0.2 THEN 'prob<0.2' WHEN prob<0.5 THEN 'prob=0.2-0.5' WHEN prob<0.8 THEN 'prob=0.5-0.8' ELSE 'prob>=0.8' END AS window_prob, CASE WHEN prob<0.3 THEN 'mean_prob<0.3' WHEN prob<0.6 THEN 'mean_prob=0.3-0.6' ELSE 'mean_prob>=0.6' END AS mean_prob,
 CASE WHEN start<6 THEN 'start<6s' WHEN start<15 THEN 'start=6-15s' ELSE 'start>=15s' END AS start, CASE WHEN share IS NULL THEN 'ood=missing' WHEN share<=0 THEN 'ood=0' WHEN share<0.3 THEN 'ood=0-0.3' ELSE 'ood>=0.3' END AS ood,
 CASE WHEN v*10<1 THEN 'quality_meta<1' WHEN v*10<10 THEN 'quality_meta=1-10' ELSE 'quality_meta>=10' END AS quality, CASE WHEN share IS NULL THEN 'missing' WHEN share<2.0/3 THEN '<2of3' WHEN share<1 THEN '2of3' ELSE '3of3' END AS green_support,
 CASE WHEN share IS NULL THEN 'missing' WHEN share<0.5 THEN 'low_corr' WHEN share<0.85 THEN 'mid_corr' ELSE 'high_corr' END AS green_corr, CASE WHEN share IS NULL THEN 'missing' WHEN share>0.6 THEN 'large_gap' WHEN share>0.25 THEN 'mid_gap' ELSE 'low_gap' END AS green_gap,
 CASE WHEN share IS NULL THEN 'missing' WHEN share<0.35 THEN 'low_stability' WHEN share<0.75 THEN 'mid_stability' ELSE 'high_stability' END AS green_stability, CASE WHEN share>0.9 THEN 'single_dominant' ELSE 'balanced_top2' END AS green_top2_ratio,
 CASE WHEN wid=0 THEN 'nwin=0' WHEN wid<=3 THEN 'nwin=1-3' WHEN wid<=10 THEN 'nwin=4-10' ELSE 'nwin>10' END AS n_windows FROM q""")
def report_bins(spark, sf_dir):
    """Every bin of the reports, on windows; missing values have bins of their own."""
    share = F.when(F.col("wid") % 4 != 3, F.col("med") / 200 - 0.1)
    source = {"window_prob": F.col("prob"), "mean_prob": F.col("prob"), "start": (F.col("wid") * 5).cast("double"), "quality": F.col("med") / 100 * 10, "n_windows": F.col("wid")}
    return event_windows(spark, sf_dir).select("user_id", "wid", *[bin_(source.get(name, share)).alias(name) for name, bin_ in exprs.REPORT_BINS.items()])


@query("""WITH n AS (SELECT p_partkey, ['IR_', 'G_IR_', 'log_IR_', 'corr_Ambient_IR', 'ACC_IR_', 'AMB_', 'IRX_'][p_size%7+1] || CASE WHEN p_size%7=3 THEN '' ELSE p_partkey::VARCHAR END AS name FROM part)
 SELECT p_partkey, name FROM n WHERE NOT regexp_matches(name, '^(IR_|IRX_|GREEN_IR_|IR_AMB_|IR_over_|log_IR_|corr_IR_|ACC_IR_)') AND name <> 'corr_Ambient_IR'""")
def infrared_policy(spark, sf_dir):
    """Names that the column policy lets through."""
    kinds = F.array(*map(F.lit, ("IR_", "G_IR_", "log_IR_", "corr_Ambient_IR", "ACC_IR_", "AMB_", "IRX_")))
    n = F.col("p_size") % 7
    name = F.concat(F.get(kinds, n), F.when(n == 3, "").otherwise(F.col("p_partkey").cast("string")))
    named = table(spark, sf_dir, "part").select("p_partkey", name.alias("name"))
    return named.where(~F.col("name").rlike("^(" + "|".join(exprs.INFRARED_PREFIXES) + ")") & ~F.col("name").isin(*exprs.INFRARED_NAMES))


@query(f"""WITH {W_SQL}, u AS (SELECT user_id, CASE WHEN avg(label)>=0.4 THEN 1 ELSE 0 END AS target, count(*) AS n, min(user_id%3) AS mode FROM e GROUP BY 1),
 g AS (SELECT u.user_id, target, mode, greatest((u.n-20)//5+1, 0) AS candidates, count(w.wid) AS ok, sum(pred) AS pos, count(*) FILTER (WHERE w.label=1 AND pred=1) AS tp, count(*) FILTER (WHERE w.label=0 AND pred=1) AS fp, count(*) FILTER (WHERE w.label=0 AND pred=0) AS tn, count(*) FILTER (WHERE w.label=1 AND pred=0) AS fn,
  avg(prob) AS m, min(prob) AS lo, max(prob) AS hi, stddev_pop(prob) AS sd, avg(CASE WHEN med>200 THEN 1.0 ELSE 0.0 END) FILTER (WHERE w.wid IS NOT NULL) AS ood, avg(CASE WHEN med>200 THEN 1.0 WHEN med IS NULL THEN NULL ELSE 0.0 END) AS alert FROM u LEFT JOIN w ON w.user_id=u.user_id GROUP BY u.user_id, target, mode, u.n),
 p AS (SELECT *, CASE WHEN coalesce(pos,0)*2>=ok AND ok>0 THEN 1 ELSE 0 END AS pred FROM g)
 SELECT user_id::VARCHAR AS sample_name, target, pred, CASE WHEN pred=target THEN 1 ELSE 0 END AS sample_is_correct, CASE WHEN target=1 AND pred=1 THEN 'TP' WHEN target=0 AND pred=1 THEN 'FP' WHEN target=1 THEN 'FN' ELSE 'TN' END AS sample_error_type, mode::INT AS ppg_config,
  CASE WHEN ok=0 THEN 1 ELSE 0 END AS is_fallback, CASE WHEN ok=0 THEN 'no_full_window' END AS fallback_reason, candidates::BIGINT AS candidate_windows, ok AS successful_windows, (candidates-ok)::BIGINT AS feature_failed_windows, (tp+tn) AS window_correct, (fp+fn) AS window_wrong,
  round((tp+tn)/nullif(ok,0),6) AS window_accuracy, round((fp+fn)/nullif(ok,0),6) AS window_error_rate, tn AS window_tn, fp AS window_fp, fn AS window_fn, tp AS window_tp, coalesce(pos,0)::BIGINT AS positive_windows, (ok-coalesce(pos,0))::BIGINT AS negative_windows, round(pos/nullif(ok,0),6) AS positive_window_rate,
  round(m,6) AS window_probability_mean, round(lo,6) AS window_probability_min, round(hi,6) AS window_probability_max, round(sd,6) AS window_probability_std, round(ood,6) AS ood_mean, round(alert,6) AS ood_window_alert_rate FROM p""")
def per_sample_summary(spark, sf_dir):
    """The inference summary of every sample in 28 columns; a sample without a full window stays, as a fallback."""
    e = events(spark, sf_dir)
    u = e.groupBy("user_id").agg((F.avg("label") >= 0.4).cast("int").alias("target"), F.count(F.lit(1)).alias("n"), F.min(F.col("user_id") % 3).cast("int").alias("ppg_config"))
    w = event_windows(spark, sf_dir).select(F.col("user_id").alias("u"), "wid", "label", "pred", "prob", (F.col("med") > 200).cast("double").alias("out"))
    j = u.join(w, F.col("u") == F.col("user_id"), "left")
    kind = F.when(F.col("wid").isNotNull(), exprs.error_type(F.col("label"), F.col("pred")))
    g = j.groupBy("user_id", "target", "n", "ppg_config").agg(
        F.count("wid").alias("ok"), F.coalesce(F.sum("pred"), F.lit(0)).cast("long").alias("pos"), *[F.count(F.when(kind == k.upper(), 1)).alias(k) for k in ("tn", "fp", "fn", "tp")],
        F.avg("prob").alias("mean"), F.min("prob").alias("min"), F.max("prob").alias("max"), F.stddev_pop("prob").alias("std"), F.avg("out").alias("ood"),
    )
    g = g.withColumn("pred", ((F.col("pos") * 2 >= F.col("ok")) & (F.col("ok") > 0)).cast("int")).withColumn("candidates", F.greatest(F.floor((F.col("n") - 20) / 5) + 1, F.lit(0)).cast("long"))
    share = lambda x: F.round(F.try_divide(x, F.col("ok")), 6)
    right, wrong = F.col("tp") + F.col("tn"), F.col("fp") + F.col("fn")
    return g.select(
        F.col("user_id").cast("string").alias("sample_name"), "target", "pred", (F.col("pred") == F.col("target")).cast("int").alias("sample_is_correct"), exprs.error_type(F.col("target"), F.col("pred")).alias("sample_error_type"), "ppg_config",
        (F.col("ok") == 0).cast("int").alias("is_fallback"), F.when(F.col("ok") == 0, "no_full_window").alias("fallback_reason"), F.col("candidates").alias("candidate_windows"), F.col("ok").alias("successful_windows"), (F.col("candidates") - F.col("ok")).alias("feature_failed_windows"),
        right.alias("window_correct"), wrong.alias("window_wrong"), share(right).alias("window_accuracy"), share(wrong).alias("window_error_rate"), *[F.col(k).alias(f"window_{k}") for k in ("tn", "fp", "fn", "tp")],
        F.col("pos").alias("positive_windows"), (F.col("ok") - F.col("pos")).alias("negative_windows"), share(F.col("pos")).alias("positive_window_rate"), *[F.round(k, 6).alias(f"window_probability_{k}") for k in ("mean", "min", "max", "std")],
        F.round("ood", 6).alias("ood_mean"), F.round("ood", 6).alias("ood_window_alert_rate"),
    )


@query("""WITH s AS (SELECT vec_id, embedding AS a, unnest(range(0, 144, 8)) AS start FROM embeddings), x AS (SELECT vec_id, start, a, (start*0.5)::INT AS lo FROM s)
 SELECT vec_id, start, CASE WHEN lo<len(a) THEN len(a[lo+1:least(lo+8, len(a))]) ELSE 0 END AS n, CASE WHEN lo<len(a) THEN round(list_sum(list_transform(a[lo+1:least(lo+8, len(a))], lambda v: v::DOUBLE)),6) END AS total FROM x""")
def time_ratio_alignment(spark, sf_dir):
    """The slice of a slower channel under each window of a faster one, by the ratio of their rates; null beyond its end."""
    a = F.col("embedding").cast("array<double>")
    x = table(spark, sf_dir, "embeddings").select("vec_id", a.alias("a"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(136).cast("long"), F.lit(8).cast("long"))).alias("start"))
    part = exprs.aligned_slice(F.col("a"), F.col("start"), F.lit(16), 0.5)
    total = F.aggregate(part, F.lit(0.0), lambda s, v: s + v)
    return x.select("vec_id", "start", F.greatest(F.coalesce(F.size(part), F.lit(0)), F.lit(0)).cast("long").alias("n"), F.round(total, 6).alias("total"))


@query(f"WITH {_EF_SQL}, m AS (SELECT feature, avg(value) AS m, stddev_pop(value) AS s FROM ef GROUP BY 1) SELECT ef.feature, round(avg(pow((value-m)/s, 3)),4) AS skewness, round((avg(value) FILTER (WHERE label=1)-avg(value) FILTER (WHERE label=0))/sqrt((var_samp(value) FILTER (WHERE label=1)+var_samp(value) FILTER (WHERE label=0))/2),6) AS mean_difference FROM ef JOIN m USING (feature) GROUP BY 1")
def shape_and_difference(spark, sf_dir):
    """Population skewness, and the standardised difference of the classes' means."""
    of = lambda y: F.when(F.col("label") == y, F.col("value"))
    pooled = F.sqrt((F.var_samp(of(1)) + F.var_samp(of(0))) / 2)
    return _event_features(spark, sf_dir).groupBy("feature").agg(F.round(F.skewness("value"), 4).alias("skewness"), F.round(F.try_divide(F.avg(of(1)) - F.avg(of(0)), pooled), 6).alias("mean_difference"))


@query(f"""WITH {L_SQL}, g AS (SELECT l_suppkey, avg(CASE WHEN (quantity>25)=(label=1) THEN 1.0 ELSE 0.0 END) AS a, avg(CASE WHEN (quantity>30)=(label=1) THEN 1.0 ELSE 0.0 END) AS b, avg(CASE WHEN quantity>25 THEN 1.0 ELSE 0.0 END) FILTER (WHERE label=0) AS fa, avg(CASE WHEN quantity>30 THEN 1.0 ELSE 0.0 END) FILTER (WHERE label=0) AS fb FROM l WHERE split='valid' GROUP BY 1)
 SELECT l_suppkey, NOT (b<a-1e-12 OR fb>fa+1e-12) AS accepted, CASE WHEN b<a-1e-12 THEN 'valid_accuracy_decreased' WHEN fb>fa+1e-12 THEN 'valid_false_positive_rate_increased' ELSE 'accuracy_not_lower_and_fpr_not_higher' END AS reason FROM g""")
def hard_negative_gate(spark, sf_dir):
    """Whether a retrained candidate replaces the former one, per group."""
    hit = lambda t: F.avg(((F.col("quantity") > t) == (F.col("label") == 1)).cast("double"))
    alarm = lambda t: F.avg(F.when(F.col("label") == 0, (F.col("quantity") > t).cast("double")))
    g = lines(spark, sf_dir).where("split = 'valid'").groupBy("l_suppkey").agg(hit(25).alias("a"), hit(30).alias("b"), alarm(25).alias("fa"), alarm(30).alias("fb"))
    return g.select("l_suppkey", scores.accept_retrained(F.col("a"), F.col("b"), F.col("fa"), F.col("fb")).alias("x")).select("l_suppkey", "x.*")
