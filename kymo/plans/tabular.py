"""Queries: projections, predicates, joins, sets and selections."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from kymo.functions import exprs
from kymo.operators import metrics
from kymo.plans.base import E_SQL, L_SQL, LF_SQL, W_SQL, event_windows, events, line_features, lines, query
from kymo.sources.tables import table


@query(f"WITH {L_SQL} SELECT l_orderkey, l_linenumber, quantity AS ir, tax AS ambient, CASE l_linenumber%3 WHEN 0 THEN price WHEN 1 THEN (price+quantity)/2 ELSE (price+quantity+discount)/3 END AS green FROM l")
def scan_layout_projection(spark, sf_dir):
    """Channel layout by configuration code: one, two or three physical channels averaged."""
    cfg = F.col("l_linenumber") % 3
    ch = F.array("price", "quantity", "discount")
    green = F.when(cfg == 0, ch[0]).when(cfg == 1, (ch[0] + ch[1]) / 2).otherwise((ch[0] + ch[1] + ch[2]) / 3)
    return lines(spark, sf_dir).select("l_orderkey", "l_linenumber", F.col("quantity").alias("ir"), F.col("tax").alias("ambient"), green.alias("green"))


@query(f"WITH {E_SQL} SELECT user_id, i, value FROM e WHERE i % 4 = 0")
def decimate_every_4th(spark, sf_dir):
    return events(spark, sf_dir).where("i % 4 = 0").select("user_id", "i", "value")


@query("SELECT p_partkey, p_name FROM part WHERE NOT regexp_matches(p_name, '(0003|0103)|(0104|0002)') AND regexp_matches(lower(concat_ws(' ', p_name, p_type)), 'promo|steel|brass')")
def name_pattern_filter(spark, sf_dir):
    """Name exclusion and a token predicate over concatenated context columns."""
    p = table(spark, sf_dir, "part")
    context = F.lower(F.concat_ws(" ", "p_name", "p_type"))
    return p.where(~F.col("p_name").rlike("(0003|0103)|(0104|0002)") & context.rlike("promo|steel|brass")).select("p_partkey", "p_name")


@query("""WITH m AS (SELECT event_id, user_id, TRY_CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events),
 r AS (SELECT *, CASE WHEN k IS NULL THEN 'missing_frequency' WHEN k NOT BETWEEN 10 AND 90 THEN 'invalid_frequency' WHEN user_id%7=0 THEN 'invalid_config' ELSE 'ok' END AS reason FROM m)
 SELECT reason, count(*) AS n FROM r GROUP BY reason""")
def metadata_reject_reasons(spark, sf_dir):
    """First reason that rejects a record, counted."""
    k = F.get_json_object("props", "$.k").try_cast("int")
    reason = F.when(k.isNull(), "missing_frequency").when(~k.between(10, 90), "invalid_frequency").when(F.col("user_id") % 7 == 0, "invalid_config").otherwise("ok")
    return table(spark, sf_dir, "events").groupBy(reason.alias("reason")).agg(F.count(F.lit(1)).alias("n"))


@query("""WITH m AS (SELECT user_id, TRY_CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events)
 SELECT user_id, CASE WHEN count(DISTINCT k%2)=1 THEN 1 ELSE 0 END AS consistent, min(k) AS lowest FROM m GROUP BY user_id""")
def metadata_agreement(spark, sf_dir):
    """Children of a record must agree on a field."""
    k = F.get_json_object("props", "$.k").try_cast("int")
    return table(spark, sf_dir, "events").select("user_id", k.alias("k")).groupBy("user_id").agg((F.countDistinct(F.col("k") % 2) == 1).cast("int").alias("consistent"), F.min("k").alias("lowest"))


@query(f"WITH {E_SQL}, x AS (SELECT *, CASE WHEN event_id%11=0 THEN NULL ELSE value END AS v FROM e) SELECT user_id, i, coalesce(v, quantile_cont(v, 0.5) OVER (PARTITION BY user_id), 0) AS filled FROM x")
def finite_fill_median(spark, sf_dir):
    from kymo.operators.series import fill_with_median

    holes = F.when(F.col("event_id") % 11 == 0, F.lit(float("nan"))).otherwise(F.col("value"))
    return fill_with_median(events(spark, sf_dir).withColumn("v", holes), "user_id", "v", "filled").select("user_id", "i", "filled")


@query(f"WITH {L_SQL}, x AS (SELECT *, CASE WHEN l_orderkey%9=0 THEN NULL ELSE price END AS p FROM l), m AS (SELECT median(p) AS med FROM x WHERE split='train') SELECT l_orderkey, l_linenumber, l_suppkey, coalesce(p, (SELECT med FROM m), 0) AS price FROM x")
def impute_train_median(spark, sf_dir):
    """Missing values take the training split's median."""
    x = lines(spark, sf_dir).withColumn("p", F.when(F.col("l_orderkey") % 9 != 0, F.col("price")))
    med = x.where("split = 'train'").agg(F.percentile("p", F.lit(0.5)).alias("med")).first()["med"]
    return x.select("l_orderkey", "l_linenumber", "l_suppkey", F.coalesce("p", F.lit(med), F.lit(0.0)).alias("price"))


@query(f"""WITH {W_SQL} SELECT user_id, wid, CASE WHEN prob<0.2 THEN 'prob<0.2' WHEN prob<0.5 THEN 'prob<0.5' WHEN prob<0.8 THEN 'prob<0.8' ELSE 'prob>=0.8' END AS prob_bin,
 CASE WHEN wid<2 THEN 'early' WHEN wid<5 THEN 'middle' ELSE 'late' END AS time_bin,
 CASE WHEN label=1 AND pred=1 THEN 'TP' WHEN label=0 AND pred=1 THEN 'FP' WHEN label=1 THEN 'FN' ELSE 'TN' END AS error_type FROM w""")
def bucketise_windows(spark, sf_dir):
    w = event_windows(spark, sf_dir)
    return w.select(
        "user_id", "wid",
        exprs.bins(F.col("prob"), [0.2, 0.5, 0.8], ["prob<0.2", "prob<0.5", "prob<0.8", "prob>=0.8"]).alias("prob_bin"),
        exprs.bins(F.col("wid").cast("double"), [2, 5], ["early", "middle", "late"]).alias("time_bin"),
        exprs.error_type(F.col("label"), F.col("pred")).alias("error_type"),
    )


@query("SELECT event_id, json_extract_string(props, '$.k') AS k, TRY_CAST(json_extract_string(props, '$.k') AS INT) AS k_int FROM events")
def json_props_extract(spark, sf_dir):
    k = F.get_json_object("props", "$.k")
    return table(spark, sf_dir, "events").select("event_id", k.alias("k"), k.try_cast("int").alias("k_int"))


@query("SELECT vec_id, embedding[5]::DOUBLE AS fifth, coalesce(embedding[100]::DOUBLE, -1.0) AS hundredth FROM embeddings")
def safe_list_get(spark, sf_dir):
    e = F.col("embedding")
    get = lambda k: F.try_element_at(e, F.lit(k)).cast("double")
    return table(spark, sf_dir, "embeddings").select("vec_id", get(5).alias("fifth"), F.coalesce(get(100), F.lit(-1.0)).alias("hundredth"))


@query("SELECT event_id, sha256(props) AS fingerprint, regexp_replace(event_type || '/' || user_id, '[^A-Za-z0-9_.-]+', '_', 'g') AS safe_name FROM events")
def sha_fingerprint(spark, sf_dir):
    name = exprs.safe_name(F.concat_ws("/", "event_type", F.col("user_id").cast("string")))
    return table(spark, sf_dir, "events").select("event_id", F.sha2("props", 256).alias("fingerprint"), name.alias("safe_name"))


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment='BUILDING')")
def semi_join_split_groups(spark, sf_dir):
    groups = table(spark, sf_dir, "customer").where("c_mktsegment = 'BUILDING'").select("c_custkey")
    orders = table(spark, sf_dir, "orders")
    return orders.join(groups, orders["o_custkey"] == groups["c_custkey"], "left_semi").select("o_orderkey", "o_totalprice")


@query("SELECT p_partkey, 'missing' AS why FROM part WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_partkey=p_partkey AND l_quantity>45) UNION ALL SELECT l_partkey, 'repeated' FROM (SELECT l_partkey FROM lineitem GROUP BY 1 HAVING count(*)>40)")
def anti_join_missing_names(spark, sf_dir):
    p, x = table(spark, sf_dir, "part"), table(spark, sf_dir, "lineitem")
    missing = p.join(x.where("l_quantity > 45"), p["p_partkey"] == x["l_partkey"], "left_anti").select("p_partkey", F.lit("missing").alias("why"))
    again = x.groupBy("l_partkey").count().where("count > 40").select(F.col("l_partkey").alias("p_partkey"), F.lit("repeated").alias("why"))
    return missing.unionByName(again)


@query("SELECT c_custkey, n_name, r_name, c_acctbal FROM customer LEFT JOIN nation ON c_nationkey=n_nationkey LEFT JOIN region ON n_regionkey=r_regionkey")
def lookup_join_catalog(spark, sf_dir):
    c, n, r = (table(spark, sf_dir, t) for t in ("customer", "nation", "region"))
    return c.join(n, c["c_nationkey"] == n["n_nationkey"], "left").join(r, n["n_regionkey"] == r["r_regionkey"], "left").select("c_custkey", "n_name", "r_name", "c_acctbal")


@query(f"WITH {W_SQL} SELECT w.user_id, w.wid, count(*) AS n_points, round(sum(e.value), 6) AS total FROM w JOIN e ON e.user_id=w.user_id AND e.i >= w.wid*5 AND e.i < w.wid*5+10 GROUP BY 1, 2")
def range_align_slice(spark, sf_dir):
    """A second signal's slice under each window: a range condition within the entity's equi-join."""
    w, e = event_windows(spark, sf_dir).select("user_id", "wid"), events(spark, sf_dir).select(F.col("user_id").alias("u"), "i", "value")
    j = w.join(e, (F.col("u") == F.col("user_id")) & (F.col("i") >= F.col("wid") * 5) & (F.col("i") < F.col("wid") * 5 + 10))
    return j.groupBy("user_id", "wid").agg(F.count(F.lit(1)).alias("n_points"), F.round(F.sum("value"), 6).alias("total"))


@query(f"WITH {E_SQL} SELECT user_id, d.deadline, max(i) AS at_index, arg_max(event_type, i) AS state FROM e JOIN (SELECT unnest([5, 10, 20, 40]) AS deadline) d ON e.i <= d.deadline GROUP BY 1, 2")
def asof_state_at_deadline(spark, sf_dir):
    """Last state at or before each deadline: each row serves the deadlines after it."""
    due = F.filter(F.array(*map(F.lit, (5, 10, 20, 40))), lambda d: F.col("i") <= d)
    rows = events(spark, sf_dir).select("user_id", "i", "event_type", F.explode(due).alias("deadline"))
    return rows.groupBy("user_id", "deadline").agg(F.max("i").alias("at_index"), F.max_by("event_type", "i").alias("state"))


@query(f"WITH {L_SQL} SELECT 'quantity' AS a, 'price' AS b, round(corr(quantity, price), 6) AS r FROM l UNION ALL SELECT 'quantity', 'discount', round(corr(quantity, discount), 6) FROM l UNION ALL SELECT 'quantity', 'tax', round(corr(quantity, tax), 6) FROM l UNION ALL SELECT 'price', 'discount', round(corr(price, discount), 6) FROM l UNION ALL SELECT 'price', 'tax', round(corr(price, tax), 6) FROM l UNION ALL SELECT 'discount', 'tax', round(corr(discount, tax), 6) FROM l")
def pairwise_feature_corr(spark, sf_dir):
    """All feature pairs in one aggregation pass; the few results are then unpivoted."""
    from itertools import combinations

    from kymo.plans.base import CHANNELS

    pairs = list(combinations(CHANNELS, 2))
    one = lines(spark, sf_dir).agg(*[F.round(exprs.guarded_corr(F.col(a), F.col(b)), 6).alias(f"{a}_{b}") for a, b in pairs])
    return one.select(F.explode(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"{a}_{b}").alias("r")) for a, b in pairs])).alias("x")).select("x.*")


@query(f"WITH {W_SQL}, d AS (SELECT user_id, list(prob ORDER BY wid) AS probs, list(pred ORDER BY wid) AS preds FROM w GROUP BY 1) SELECT user_id, unnest(range(len(probs)))::INT AS pos, unnest(probs) AS prob, unnest(preds) AS pred FROM d")
def zip_arrays_explode(spark, sf_dir):
    """Per-entity arrays and back to rows by position."""
    d = event_windows(spark, sf_dir).groupBy("user_id").agg(F.array_sort(F.collect_list(F.struct("wid", "prob", "pred"))).alias("s"))
    d = d.select("user_id", F.arrays_zip(F.col("s.prob").alias("prob"), F.col("s.pred").alias("pred")).alias("z"))
    return d.select("user_id", F.posexplode("z").alias("pos", "r")).select("user_id", "pos", "r.prob", "r.pred")


@query("SELECT 'train' AS split, c_custkey AS id, c_acctbal AS value FROM customer UNION ALL SELECT 'valid', s_suppkey, s_acctbal FROM supplier UNION ALL SELECT 'test', p_partkey, NULL FROM part")
def union_splits(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select(F.lit("train").alias("split"), F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("value"))
    s = table(spark, sf_dir, "supplier").select(F.lit("valid").alias("split"), F.col("s_suppkey").alias("id"), F.col("s_acctbal").alias("value"))
    return c.unionByName(s).unionByName(table(spark, sf_dir, "part").select(F.lit("test").alias("split"), F.col("p_partkey").alias("id")), allowMissingColumns=True)


@query(f"WITH {E_SQL} SELECT user_id, arg_min(event_type, i) AS first_type, arg_min(label, i) AS target FROM e GROUP BY 1")
def distinct_groups_first(spark, sf_dir):
    return events(spark, sf_dir).groupBy("user_id").agg(F.min_by("event_type", "i").alias("first_type"), F.min_by("label", "i").alias("target"))


@query("SELECT s_nationkey AS k, 'both' AS side FROM (SELECT s_nationkey FROM supplier INTERSECT SELECT c_nationkey FROM customer WHERE c_acctbal>9000) UNION ALL SELECT c_nationkey, 'left' FROM (SELECT c_nationkey FROM customer WHERE c_acctbal>9000 EXCEPT SELECT s_nationkey FROM supplier)")
def feature_set_operations(spark, sf_dir):
    s, c = table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("k")), table(spark, sf_dir, "customer").where("c_acctbal > 9000").select(F.col("c_nationkey").alias("k"))
    return s.intersect(c).withColumn("side", F.lit("both")).unionByName(c.exceptAll(c.intersect(s)).distinct().join(s, "k", "left_anti").withColumn("side", F.lit("left")))


@query(f"WITH {W_SQL} SELECT user_id, count(DISTINCT round(prob, 2)) AS n_thresholds, min(round(prob, 2)) AS lowest, max(round(prob, 2)) AS highest FROM w GROUP BY 1")
def threshold_candidates(spark, sf_dir):
    """Rounded, deduplicated and sorted candidate thresholds of each entity."""
    t = event_windows(spark, sf_dir).groupBy("user_id").agg(F.array_sort(F.collect_set(F.round("prob", 2))).alias("t"))
    return t.select("user_id", F.size("t").cast("long").alias("n_thresholds"), F.element_at("t", 1).alias("lowest"), F.element_at("t", -1).alias("highest"))


@query("SELECT p_partkey, p_brand, p_retailprice, group_rank FROM (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY p_retailprice DESC, p_partkey) AS group_rank FROM part) WHERE group_rank <= CASE WHEN right(p_brand, 1) = '1' THEN 2 ELSE 3 END ORDER BY p_retailprice DESC, p_partkey LIMIT 25")
def topk_per_group_caps(spark, sf_dir):
    cap = F.when(F.col("p_brand").endswith("1"), 2).otherwise(3)
    return metrics.top_with_caps(table(spark, sf_dir, "part"), "p_brand", [F.desc("p_retailprice"), F.col("p_partkey")], cap, 25).select("p_partkey", "p_brand", "p_retailprice", F.col("group_rank").cast("long").alias("group_rank"))


@query("""WITH r AS (SELECT l_suppkey AS candidate, round(avg(CASE WHEN l_returnflag='R' THEN 1.0 ELSE 0.0 END), 2) AS acc, count(*) AS nodes, round(avg(l_discount), 4) AS fpr FROM lineitem GROUP BY 1)
 SELECT candidate, acc, nodes, fpr FROM r WHERE fpr <= 0.06 ORDER BY acc DESC, fpr, nodes, candidate LIMIT 1""")
def tie_chain_select(spark, sf_dir):
    """Constrained best candidate with an explicit chain of tie-breakers."""
    r = table(spark, sf_dir, "lineitem").groupBy(F.col("l_suppkey").alias("candidate")).agg(F.round(F.avg((F.col("l_returnflag") == "R").cast("double")), 2).alias("acc"), F.count(F.lit(1)).alias("nodes"), F.round(F.avg("l_discount"), 4).alias("fpr"))
    return r.where("fpr <= 0.06").orderBy(F.desc("acc"), "fpr", "nodes", "candidate").limit(1)


@query(f"WITH {E_SQL} SELECT event_id, label, split FROM (SELECT *, row_number() OVER (PARTITION BY label, split ORDER BY (event_id*2654435761)%4294967296, event_id) AS r FROM e) WHERE r <= 40")
def stratified_sample_hash(spark, sf_dir):
    key = F.struct(exprs.mult_hash(F.col("event_id")), F.col("event_id"))
    return metrics.stratified_sample(events(spark, sf_dir), ["label", "split"], key, 40).select("event_id", "label", "split")


@query("""WITH g AS (SELECT a*5+b AS pid, (a+2)/10.0::DOUBLE AS alpha, (b+3)/10.0::DOUBLE AS t_on FROM range(5) x(a), range(5) y(b)), p AS (SELECT *, abs(alpha-0.4)+abs(t_on-0.5) AS far FROM g)
 SELECT pid, alpha, t_on FROM (SELECT *, row_number() OVER (ORDER BY round(far, 9), pid) AS r FROM p) WHERE r <= 8 OR pid IN (0, 24)""")
def grid_budget_with_anchors(spark, sf_dir):
    """Parameter grid cut to a budget by distance from the default, anchors always kept."""
    g = spark.range(25).select(F.col("id").alias("pid"), ((F.floor(F.col("id") / 5) + 2) / 10.0).alias("alpha"), ((F.col("id") % 5 + 3) / 10.0).alias("t_on"))
    far = F.round(F.abs(F.col("alpha") - 0.4) + F.abs(F.col("t_on") - 0.5), 9)
    r = F.row_number().over(Window.orderBy(far, "pid"))  # a parameter grid, never data
    return g.withColumn("r", r).where((F.col("r") <= 8) | F.col("pid").isin(0, 24)).drop("r")


@query(f"WITH {LF_SQL} SELECT feature, split, round(avg(value), 6) AS mean, count(*) AS n FROM lf GROUP BY 1, 2")
def long_feature_table(spark, sf_dir):
    return line_features(spark, sf_dir).groupBy("feature", "split").agg(F.round(F.avg("value"), 6).alias("mean"), F.count(F.lit(1)).alias("n"))


@query("SELECT doc_id, source, row_number() OVER (PARTITION BY lang ORDER BY n_chars DESC, doc_id) AS rank_in_lang FROM documents")
def rank_rows(spark, sf_dir):
    w = Window.partitionBy("lang").orderBy(F.desc("n_chars"), "doc_id")
    return table(spark, sf_dir, "documents").select("doc_id", "source", F.row_number().over(w).cast("long").alias("rank_in_lang"))


@query("SELECT vec_id, round(sqrt(embedding[1]::DOUBLE*embedding[1]::DOUBLE+embedding[2]::DOUBLE*embedding[2]::DOUBLE+embedding[3]::DOUBLE*embedding[3]::DOUBLE), 6) AS magnitude, round(embedding[1]::DOUBLE / CASE WHEN abs(embedding[2]::DOUBLE)>=0.05 THEN embedding[2]::DOUBLE WHEN embedding[2]<0 THEN -0.05 ELSE 0.05 END, 6) AS ratio FROM embeddings")
def magnitude_and_guarded_ratio(spark, sf_dir):
    x = [F.col("embedding")[k].cast("double") for k in range(3)]
    return table(spark, sf_dir, "embeddings").select("vec_id", F.round(F.sqrt(x[0] * x[0] + x[1] * x[1] + x[2] * x[2]), 6).alias("magnitude"), F.round(exprs.guarded_ratio(x[0], x[1], F.lit(0.05)), 6).alias("ratio"))
