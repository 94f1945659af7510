"""Queries: candidate sets, swaps, workload, contracts of windows and selections, artifacts that are written and read again."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from kymo.operators import subsets
from kymo.plans.base import L_SQL, W_SQL, event_windows, lines, query
from kymo.session import fresh_folder
from kymo.sources import artifacts
from kymo.sources.tables import table

_LIMITS = {"green_contact": 3, "frequency": 1, "acc_motion": 4, "other": 0}
_BASELINE = ["f7", "f3", "f11", "f1999", "f42", "f5", "f100", "missing"]
_GROUPS = [*subsets.FOCUS, "other"]
_listed = lambda xs: "[" + ", ".join(f"'{x}'" for x in xs) + "]"
_LIMIT_SQL = "CASE grp " + " ".join(f"WHEN '{g}' THEN {n}" for g, n in _LIMITS.items()) + " ELSE 2 END"
_BEAM_SQL = " UNION ALL ".join(
    f"SELECT '{name}', 15, CASE WHEN within<=3 THEN coalesce(nullif(list_position({_listed(b + [g for g in subsets.FOCUS if g not in b])}, grp), 0)-1, 8) ELSE 8 END::DOUBLE, -score, feature, grp, position, {_LIMIT_SQL} FROM r" for name, b in subsets.BEAMS.items()
)


@query(f"""WITH r0 AS (SELECT 'f' || p_partkey AS feature, {_listed(_GROUPS)}[p_size%9+1] AS grp, p_partkey AS position, p_retailprice/2000.0::DOUBLE AS score,
  coalesce(CASE WHEN p_size%10<>0 THEN p_size/50.0::DOUBLE END, 0.5::DOUBLE) AS fp_rate, (p_partkey%33)/8.0::DOUBLE AS cost FROM part),
 r AS (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY score DESC, position) AS within, 0.4::DOUBLE*score+0.3::DOUBLE*(1.0::DOUBLE-fp_rate)+0.3::DOUBLE*(1.0::DOUBLE-cost/4.0::DOUBLE) AS balanced FROM r0),
 e(strategy, n, a, b, feature, grp, position, lim) AS (SELECT 'accuracy_first_15', 15, -score, 0::DOUBLE, feature, grp, position, {_LIMIT_SQL} FROM r UNION ALL SELECT 'fp_safe_15', 15, fp_rate, -score, feature, grp, position, {_LIMIT_SQL} FROM r
  UNION ALL SELECT 'deployment_light_15', 15, cost, -score, feature, grp, position, {_LIMIT_SQL} FROM r UNION ALL SELECT 'balanced_15', 15, -balanced, 0, feature, grp, position, {_LIMIT_SQL} FROM r UNION ALL SELECT 'balanced_12', 12, -balanced, 0, feature, grp, position, {_LIMIT_SQL} FROM r
  UNION ALL {_BEAM_SQL} UNION ALL SELECT 'commercial_8_baseline', 8, list_position({_listed(_BASELINE)}, feature), 0, feature, grp, position, 8 FROM r WHERE list_contains({_listed(_BASELINE)}, feature)),
 g AS (SELECT *, row_number() OVER (PARTITION BY strategy, grp ORDER BY a, b, position) AS k FROM e),
 p AS (SELECT *, row_number() OVER (PARTITION BY strategy ORDER BY a, b, position) AS place FROM g WHERE k<=lim)
 SELECT strategy, place, feature, grp FROM p WHERE place<=n""")
def subset_candidates(spark, sf_dir):
    """Nine named candidate sets under limits by group; parts stand for ranked features."""
    p = table(spark, sf_dir, "part")
    grp = F.get(F.array(*map(F.lit, _GROUPS)), F.col("p_size") % 9)
    rate = F.when(F.col("p_size") % 10 != 0, F.col("p_size") / F.lit(50.0))
    r = p.select(F.concat(F.lit("f"), F.col("p_partkey")).alias("feature"), grp.alias("grp"), F.col("p_partkey").alias("position"), (F.col("p_retailprice") / 2000.0).alias("score"), rate.alias("fp_rate"), ((F.col("p_partkey") % 33) / 8.0).alias("cost"))
    return subsets.candidates(r, _LIMITS, _BASELINE)


@query("""WITH r AS (SELECT s_nationkey, s_name, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_acctbal DESC, s_suppkey) AS p FROM supplier),
 b AS (SELECT *, count(*) OVER (PARTITION BY s_nationkey) AS n FROM r WHERE p<=5),
 c AS (SELECT b.s_nationkey, b.p AS spot, q.p AS k, q.s_name AS incoming FROM b JOIN r q ON q.s_nationkey=b.s_nationkey AND q.p BETWEEN 6 AND 13 WHERE b.p > b.n-3),
 d AS (SELECT *, row_number() OVER (PARTITION BY s_nationkey ORDER BY spot, k)-1 AS candidate FROM c)
 SELECT d.s_nationkey, candidate, string_agg(CASE WHEN b.p=d.spot THEN incoming ELSE b.s_name END, ',' ORDER BY b.p) AS features FROM d JOIN b ON b.s_nationkey=d.s_nationkey WHERE candidate<12 GROUP BY 1, 2""")
def local_swap_sets(spark, sf_dir):
    """Sets one swap away from each nation's five richest suppliers; only the thirteen first of a nation are gathered."""
    place = F.row_number().over(Window.partitionBy("s_nationkey").orderBy(F.desc("s_acctbal"), "s_suppkey"))
    r = table(spark, sf_dir, "supplier").withColumn("p", place).where("p <= 13")
    names = F.transform(F.sort_array(F.collect_list(F.struct("p", "s_name"))), lambda x: x["s_name"])
    sets = r.groupBy("s_nationkey").agg(names.alias("ranked")).withColumn("base", F.slice("ranked", 1, 5))
    swaps = subsets.local_swaps(sets, "base", "ranked")
    return swaps.select("s_nationkey", F.col("candidate").cast("long").alias("candidate"), F.concat_ws(",", "features").alias("features"))


@query(f"""WITH {L_SQL}, s AS (SELECT l_linenumber, count(*) FILTER (WHERE split='train') AS t, count(*) FILTER (WHERE split='valid') AS v, l_linenumber*15 AS f, least(l_linenumber, 6) AS n FROM l GROUP BY 1),
 k AS (SELECT *, 3*least(5, n) AS folds, (t>=10000)::INT AS long FROM s),
 u AS (SELECT l_linenumber, 'clean' AS step, 1+(f>=40)::INT+(f>=80)::INT+long AS p, f AS work_items FROM k UNION ALL SELECT l_linenumber, 'stability', 1+(folds>=12)::INT+(f>=60)::INT+long, folds FROM k
  UNION ALL SELECT l_linenumber, 'shap', 1+long+(f>=60)::INT, t*f FROM k UNION ALL SELECT l_linenumber, 'diagnostics', 1+(f>=80)::INT+(t+v>=20000)::INT, f FROM k UNION ALL SELECT l_linenumber, 'subset_search', 2, 6 FROM k)
 SELECT l_linenumber, step, CASE WHEN p>=3 THEN 'high' WHEN p>=2 THEN 'medium' ELSE 'low' END AS risk, work_items FROM u""")
def workload_estimate(spark, sf_dir):
    """Risk and work items of every selection step, by the row counts of each line number."""
    of = lambda s: F.count_if(F.col("split") == s)
    n = F.col("l_linenumber")
    s = lines(spark, sf_dir).groupBy("l_linenumber").agg(of("train").alias("n_train_rows"), of("valid").alias("n_valid_rows"))
    return subsets.workload(s.withColumn("n_features", n * 15).withColumn("n_samples", F.least(n, F.lit(6))), shap=True, subset_search=True)


@query("""WITH c AS (SELECT p_partkey, CASE p_partkey%8 WHEN 0 THEN NULL WHEN 1 THEN 'five' WHEN 2 THEN 'nan' WHEN 3 THEN '5.000000000001' ELSE (p_size%3+4)::VARCHAR END AS w,
  CASE WHEN p_size%11=0 THEN NULL ELSE '5' END AS tw, CASE p_partkey%5 WHEN 0 THEN 'inf' ELSE '1' END AS s, CASE p_size%4 WHEN 0 THEN '0.5' ELSE '1.0' END AS ts FROM part),
 d AS (SELECT *, try_cast(w AS DOUBLE) AS wd, try_cast(tw AS DOUBLE) AS twd, try_cast(s AS DOUBLE) AS sd, try_cast(ts AS DOUBLE) AS tsd FROM c)
 SELECT p_partkey, CASE WHEN tw IS NULL THEN 'window_sec required' WHEN wd IS NULL OR twd IS NULL THEN 'window_sec not numeric' WHEN NOT isfinite(wd) OR NOT isfinite(twd) THEN 'window_sec not finite' WHEN abs(wd-twd)>1e-9+1e-9*abs(twd) THEN 'window_sec differs'
  WHEN ts IS NULL THEN 'stride_sec required' WHEN sd IS NULL OR tsd IS NULL THEN 'stride_sec not numeric' WHEN NOT isfinite(sd) OR NOT isfinite(tsd) THEN 'stride_sec not finite' WHEN abs(sd-tsd)>1e-9+1e-9*abs(tsd) THEN 'stride_sec differs' END AS fault FROM d""")
def window_contract(spark, sf_dir):
    """First reason why window settings do not match the trained ones; parts stand for requests."""
    key, size = F.col("p_partkey"), F.col("p_size")
    window = F.when(key % 8 == 0, None).when(key % 8 == 1, "five").when(key % 8 == 2, "nan").when(key % 8 == 3, "5.000000000001").otherwise((size % 3 + 4).cast("string"))
    trained = {"window_sec": F.when(size % 11 != 0, "5"), "stride_sec": F.when(size % 4 == 0, "0.5").otherwise("1.0")}
    stride = F.when(key % 5 == 0, "inf").otherwise("1")
    return table(spark, sf_dir, "part").select("p_partkey", subsets.window_contract_fault({"window_sec": window, "stride_sec": stride}, trained).alias("fault"))


@query("""WITH s AS (SELECT p_brand, CASE WHEN p_size%5=0 THEN [p_size, 75] WHEN b%4=0 THEN [p_size, 75, 6] WHEN b%4=1 THEN [p_size, 6, 125] WHEN b%4=2 THEN [p_size, CASE WHEN p_partkey%2=0 THEN 75 ELSE 125 END, 6]
   ELSE [p_size, 75, CASE WHEN p_partkey%3=0 THEN 125 ELSE 6 END] END AS shape, CASE WHEN p_partkey%7=0 THEN 'none' ELSE '25' END AS frequency FROM (SELECT *, substr(p_brand, 7)::INT AS b FROM part)),
 f AS (SELECT p_brand, coalesce(len(shape)=3 AND list_contains(shape[2:3], 3*try_cast(frequency AS INT)), false)::INT AS s3, coalesce(len(shape)=3 AND list_contains(shape[2:3], 5*try_cast(frequency AS INT)), false)::INT AS s5 FROM s),
 g AS (SELECT p_brand, max(s3) AS s3, max(s5) AS s5, max(s3+s5) AS most FROM f GROUP BY 1)
 SELECT p_brand, CASE WHEN s3+s5=1 THEN CASE WHEN s3=1 THEN 3 ELSE 5 END END::BIGINT AS window_sec, CASE WHEN most>1 THEN 'ambiguous' WHEN s3+s5>1 THEN 'mixed' END AS fault FROM g""")
def native_window_length(spark, sf_dir):
    """The window length that the stored windows of each group share, or why there is none."""
    p, b = table(spark, sf_dir, "part"), F.substr("p_brand", F.lit(7)).cast("int")
    size, key, lit = F.col("p_size"), F.col("p_partkey"), F.lit
    shape = (
        F.when(size % 5 == 0, F.array(size, lit(75))).when(b % 4 == 0, F.array(size, lit(75), lit(6))).when(b % 4 == 1, F.array(size, lit(6), lit(125)))
        .when(b % 4 == 2, F.array(size, F.when(key % 2 == 0, 75).otherwise(125), lit(6))).otherwise(F.array(size, lit(75), F.when(key % 3 == 0, 125).otherwise(6)))
    )
    samples = p.select("p_brand", shape.alias("shape"), F.when(key % 7 == 0, "none").otherwise("25").alias("frequency"))
    return subsets.native_duration(samples, ["p_brand"])


@query("""SELECT vec_id, CASE WHEN vec_id%5=0 THEN vec_id ELSE vec_id+1 END AS window_number, (CASE WHEN vec_id%7=0 THEN label ELSE vec_id%2 END)::BIGINT AS window_target, (CASE WHEN vec_id%5=0 THEN vec_id ELSE vec_id+1 END)*0.5::DOUBLE AS start_sec,
 (CASE WHEN vec_id%5=0 THEN vec_id ELSE vec_id+1 END)*0.5::DOUBLE+2.56::DOUBLE AS end_sec, CASE WHEN vec_id%11=0 THEN 'window has 60 samples, not 64' END AS error FROM embeddings""")
def prewindowed_times(spark, sf_dir):
    """Stored windows keep their cut: times follow from the index, a wrong length is told."""
    v = F.col("vec_id")
    length = F.size(F.when(v % 11 == 0, F.slice("embedding", 1, 60)).otherwise(F.col("embedding")))
    records = table(spark, sf_dir, "embeddings").select("vec_id", v.alias("position"), F.when(v % 5 != 0, v + 1).alias("window_index"), F.when(v % 7 != 0, v % 2).alias("window_label"), F.col("label").cast("long").alias("target"), length.alias("length"))
    return subsets.stored_windows(records, 2.56, 0.5, 25)


@query("""WITH g AS (SELECT p_partkey AS row, p_name AS feature, CASE WHEN p_size%6<>0 THEN p_retailprice END AS score, p_type AS unit, p_size<40 AS eligible FROM part),
 e AS (SELECT row, CASE WHEN row%97=0 THEN 'other' ELSE feature END AS feature, CASE WHEN row%41=0 THEN '1' WHEN row%43=0 THEN NULL ELSE score::VARCHAR END AS score, CASE WHEN row%53=0 THEN 'edited' ELSE unit END AS unit,
   CASE row%50 WHEN 0 THEN 'x' WHEN 1 THEN '1' WHEN 2 THEN '1' ELSE '0' END AS selected FROM g WHERE row%199<>3 UNION ALL SELECT -1, 'new', NULL, 'm', '0'),
 a AS (SELECT DISTINCT p_name AS feature FROM part WHERE p_name LIKE '%e%'),
 j AS (SELECT coalesce(e.row, g.row) AS row, coalesce(g.feature, e.feature) AS feature, e.feature AS ef, g.feature AS gf, e.score AS es, g.score AS gs, e.unit AS eu, g.unit AS gu, e.row IS NULL AS lost, g.row IS NULL AS added, selected, eligible, a.feature IS NOT NULL AS there FROM e FULL JOIN g ON e.row=g.row LEFT JOIN a ON a.feature=e.feature),
 k AS (SELECT *, selected='1' AND row_number() OVER (PARTITION BY ef, coalesce(selected='1', false) ORDER BY row)>1 AS again FROM j)
 SELECT row, feature, 'row missing' AS fault FROM k WHERE lost UNION ALL SELECT row, feature, 'row added' FROM k WHERE added
 UNION ALL SELECT row, feature, 'feature changed' FROM k WHERE NOT lost AND NOT added AND ef<>gf UNION ALL SELECT row, feature, 'unit changed' FROM k WHERE NOT lost AND NOT added AND eu<>gu
 UNION ALL SELECT row, feature, 'score changed' FROM k WHERE NOT lost AND NOT added AND CASE WHEN gs IS NULL THEN coalesce(es, '')<>'' ELSE NOT coalesce(abs(es::DOUBLE-gs)<=1e-12*greatest(1, abs(gs)), false) END
 UNION ALL SELECT row, feature, 'selected is not 0 or 1' FROM k WHERE NOT lost AND NOT added AND selected NOT IN ('0', '1') UNION ALL SELECT row, feature, 'selected twice' FROM k WHERE NOT lost AND NOT added AND again
 UNION ALL SELECT row, feature, 'not eligible' FROM k WHERE NOT lost AND NOT added AND selected='1' AND NOT eligible UNION ALL SELECT row, feature, 'not in train and valid' FROM k WHERE NOT lost AND NOT added AND selected='1' AND NOT there""")
def manual_selection_faults(spark, sf_dir):
    """Every fault of an edited selection table against the governed one; parts stand for features."""
    p, row = table(spark, sf_dir, "part"), F.col("row")
    g = p.select(F.col("p_partkey").alias("row"), F.col("p_name").alias("feature"), F.when(F.col("p_size") % 6 != 0, F.col("p_retailprice")).alias("score"), F.col("p_type").alias("unit"), (F.col("p_size") < 40).alias("eligible"))
    e = g.where(row % 199 != 3).select(
        "row", F.when(row % 97 == 0, "other").otherwise(F.col("feature")).alias("feature"), F.when(row % 41 == 0, "1").when(row % 43 == 0, None).otherwise(F.col("score").cast("string")).alias("score"),
        F.when(row % 53 == 0, "edited").otherwise(F.col("unit")).alias("unit"), F.when(row % 50 == 0, "x").when((row % 50).isin(1, 2), "1").otherwise("0").alias("selected"),
    )
    e = e.unionByName(spark.createDataFrame([(-1, "new", None, "m", "0")], e.schema))
    return subsets.selection_faults(e, g, p.where(F.col("p_name").contains("e")).select(F.col("p_name").alias("feature")), ["score"], ["unit"])


@query("""SELECT s_suppkey, s_name || ', "' || n_name || '"' AS quoted, CASE s_nationkey%5 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE n_name || chr(10) || s_name END AS note, s_acctbal/3 AS third FROM supplier JOIN nation ON s_nationkey=n_nationkey""")
def csv_round_trip(spark, sf_dir):
    """Quotes, line breaks, nulls, empty texts and doubles come back from CSV as they went."""
    s = table(spark, sf_dir, "supplier").join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    note = F.when(F.col("s_nationkey") % 5 == 0, None).when(F.col("s_nationkey") % 5 == 1, "").otherwise(F.concat("n_name", F.lit("\n"), "s_name"))
    rows = s.select("s_suppkey", F.concat("s_name", F.lit(', "'), "n_name", F.lit('"')).alias("quoted"), note.alias("note"), (F.col("s_acctbal") / 3).alias("third"))
    path = fresh_folder(spark, "csv")
    artifacts.write_csv(rows, path)
    return artifacts.read_csv(spark, path, rows.schema)


@query(f"""WITH {W_SQL} SELECT split, user_id::VARCHAR AS sample_name, label AS target, wid AS window_index, wid*5.0::DOUBLE AS start_sec, wid*5.0::DOUBLE+20 AS end_sec, round(prob, 9) AS prob_raw, pred AS pred_raw, 1.0::DOUBLE AS quality,
 CASE WHEN split='valid' THEN 0.0::DOUBLE ELSE 0.25::DOUBLE END AS ood_rate FROM w WHERE split<>'train'""")
def window_table_round_trip(spark, sf_dir):
    """Window outputs by split, one split replaced later, read again after the check of their contract."""
    w = event_windows(spark, sf_dir).select("split", F.col("user_id").alias("sample_name"), F.col("label").alias("target"), F.col("wid").alias("window_index"), F.col("prob").alias("prob_raw"))
    path, model = fresh_folder(spark, "windows"), {"fingerprint": {"trees": 3}, "features": ["med"]}
    artifacts.write_windows(w.withColumn("ood_rate", F.lit(float("nan"))), path, 20, 5, 0.5, **model)
    artifacts.write_windows(w.where("split = 'test'").withColumn("ood_rate", F.lit(0.25)), path, 20, 5, 0.5, **model)
    expected = {"model_fingerprint": model["fingerprint"], "feature_names": model["features"], "window_sec": 20.0}
    both = artifacts.read_windows(spark, path, "valid", expected, required=False).unionByName(artifacts.read_windows(spark, path, "test", expected, required=False))
    return both.select("split", *artifacts.WINDOW_COLUMNS).withColumn("prob_raw", F.round("prob_raw", 9))
