"""Queries: windows over ordered series, spectra, and the state machine."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from kymo.functions.exprs import quality_soft, safe_div
from kymo.operators import series, spectral, state
from kymo.plans.base import E_SQL, V_SQL, W_SQL, event_windows, events, query, vectors
from kymo.sources.tables import table


def _U():  # noqa: N802
    return Window.partitionBy("user_id")


def _O():  # noqa: E743, N802
    return _U().orderBy("i")


@query(f"WITH {W_SQL} SELECT user_id, wid, n, med, round(prob,6) AS prob, label, pred FROM w")
def sliding_windows(spark, sf_dir):
    return event_windows(spark, sf_dir).select("user_id", "wid", "n", "med", F.round("prob", 6).alias("prob"), "label", "pred")


@query(f"WITH {E_SQL} SELECT user_id, i//20 AS wid, round(avg(value),6) AS mean, max(value) AS peak FROM e GROUP BY 1, 2 HAVING count(*)=20")
def tumbling_windows(spark, sf_dir):
    return series.full_windows(events(spark, sf_dir).withColumn("wid", F.floor(F.col("i") / 20)), ["user_id", "wid"], 20, F.round(F.avg("value"), 6).alias("mean"), F.max("value").alias("peak")).drop("n")


@query(f"""WITH {E_SQL}, t AS (SELECT *, CASE WHEN user_id%2=1 THEN 15 ELSE 5 END AS s FROM e) SELECT t.user_id, g.wid, round(avg(value),6) AS mean FROM t JOIN (SELECT unnest(generate_series(0,1000)) AS wid) g ON t.i BETWEEN g.wid*s AND g.wid*s+19 GROUP BY 1, 2 HAVING count(*)=20""")
def target_aware_stride(spark, sf_dir):
    stride = F.when(F.col("user_id") % 2 == 1, 15).otherwise(5)
    rows = series.sliding_windows(events(spark, sf_dir).select("user_id", "i", "value"), 20, stride)
    return series.full_windows(rows, ["user_id", "wid"], 20, F.round(F.avg("value"), 6).alias("mean")).drop("n")


@query(f"WITH {E_SQL} SELECT user_id, i, median(value) OVER (PARTITION BY user_id ORDER BY i ROWS BETWEEN 10 PRECEDING AND 10 FOLLOWING) AS med FROM e")
def rolling_median_21(spark, sf_dir):
    return events(spark, sf_dir).select("user_id", "i", series.rolling_median(F.col("value"), "user_id", ["i"], -10, 10).alias("med"))


@query(f"WITH {E_SQL} SELECT user_id, i, median(prob) OVER (PARTITION BY user_id ORDER BY i ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS med FROM e")
def causal_median_3(spark, sf_dir):
    return events(spark, sf_dir).select("user_id", "i", series.rolling_median(F.col("prob"), "user_id", ["i"], -2, 0).alias("med"))


@query(f"WITH {E_SQL}, x AS (SELECT user_id, i, [lag(value,2,0) OVER w, lag(value,1,0) OVER w, value, lead(value,1,0) OVER w, lead(value,2,0) OVER w] AS v FROM e WINDOW w AS (PARTITION BY user_id ORDER BY i)) SELECT user_id, i, list_sort(v)[3] AS med FROM x")
def median5_zero_padded(spark, sf_dir):
    return events(spark, sf_dir).select("user_id", "i", series.median5_zero_padded(F.col("value"), "user_id", ["i"]).alias("med"))


@query(f"WITH {E_SQL} SELECT user_id, i, round(sum(value) OVER (PARTITION BY user_id ORDER BY i ROWS BETWEEN 2 PRECEDING AND 1 FOLLOWING)/4,6) AS centred, round(sum(value) OVER (PARTITION BY user_id ORDER BY i ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)/5,6) AS trailing FROM e")
def moving_averages(spark, sf_dir):
    v = F.col("value")
    trailing = F.sum(v).over(series.frame("user_id", ["i"], -4, 0)) / 5
    return events(spark, sf_dir).select("user_id", "i", F.round(series.same_mean(v, "user_id", ["i"], 4), 6).alias("centred"), F.round(trailing, 6).alias("trailing"))


@query(f"""WITH {E_SQL}, d AS (SELECT *, lag(value) OVER w AS b, lead(value) OVER w AS a FROM e WINDOW w AS (PARTITION BY user_id ORDER BY i)), m AS (SELECT user_id, mad(value-b) AS mad FROM d GROUP BY 1)
 SELECT d.user_id, i, CASE WHEN coalesce(abs(value-b)>1.5*greatest(mad,1e-12) AND abs(value-a)>1.5*greatest(mad,1e-12), false) THEN (a+b)/2 ELSE value END AS repaired FROM d JOIN m USING (user_id)""")
def spike_repair(spark, sf_dir):
    e = series.repair_spikes(events(spark, sf_dir), "user_id", ["i"], "value", 1.5)
    return e.select("user_id", "i", "repaired")


@query(f"""WITH RECURSIVE {E_SQL}, m AS (SELECT user_id, i, value AS kept FROM e WHERE i=0 UNION ALL SELECT e.user_id, e.i, CASE WHEN abs(e.value-m.kept)<=60 THEN e.value ELSE m.kept END FROM m JOIN e ON e.user_id=m.user_id AND e.i=m.i+1) SELECT user_id, i::INT AS i, kept FROM m""")
def sequential_step_repair(spark, sf_dir):
    s = state.ordered_series(events(spark, sf_dir), ["user_id"], ["i"], "value")
    fixed = s.select("user_id", F.posexplode(series.sequential_repair(F.col("series.value"), F.lit(60.0))).alias("i", "kept"))
    return fixed


@query(f"""WITH {E_SQL}, d AS (SELECT user_id, value-lag(value) OVER w AS d, value-median(value) OVER (PARTITION BY user_id) AS c FROM e WINDOW w AS (PARTITION BY user_id ORDER BY i)),
 m AS (SELECT user_id, mad(d) AS mad FROM d GROUP BY 1) SELECT d.user_id, round(avg(CASE WHEN abs(d)<=5 THEN 1.0 ELSE 0.0 END) FILTER (WHERE d IS NOT NULL),6) AS flat_ratio, round(avg(CASE WHEN abs(d)>2*mad THEN 1.0 ELSE 0.0 END) FILTER (WHERE d IS NOT NULL),6) AS spike_ratio FROM d JOIN m USING (user_id) GROUP BY 1""")
def flat_and_spike_ratio(spark, sf_dir):
    d = events(spark, sf_dir).select("user_id", (F.col("value") - F.lag("value").over(_O())).alias("d")).where("d IS NOT NULL")
    d = d.withColumn("m", F.percentile("d", F.lit(0.5)).over(_U())).withColumn("mad", F.percentile(F.abs(F.col("d") - F.col("m")), F.lit(0.5)).over(_U()))
    return d.groupBy("user_id").agg(F.round(F.avg((F.abs("d") <= 5).cast("double")), 6).alias("flat_ratio"), F.round(F.avg((F.abs("d") > 2 * F.col("mad")).cast("double")), 6).alias("spike_ratio"))


@query(f"""WITH {E_SQL}, c AS (SELECT user_id, i, sign(value-median(value) OVER (PARTITION BY user_id)) AS s FROM e), z AS (SELECT user_id, s, lag(s) OVER (PARTITION BY user_id ORDER BY i) AS b FROM c) SELECT user_id, round(avg(CASE WHEN s*b<0 THEN 1.0 ELSE 0.0 END) FILTER (WHERE b IS NOT NULL),6) AS rate FROM z GROUP BY 1""")
def zero_cross_rate(spark, sf_dir):
    c = events(spark, sf_dir).select("user_id", "i", F.signum(F.col("value") - F.percentile("value", F.lit(0.5)).over(_U())).alias("s"))
    z = c.select("user_id", "s", F.lag("s").over(_O()).alias("b")).where("b IS NOT NULL")
    return z.groupBy("user_id").agg(F.round(F.avg((F.col("s") * F.col("b") < 0).cast("double")), 6).alias("rate"))


@query(f"""WITH {E_SQL}, n AS (SELECT *, count(*) OVER (PARTITION BY user_id) AS n FROM e), s AS (SELECT user_id, least(i//(n//3), 2) AS seg, median(value) AS dc, mad(value) AS ac FROM n GROUP BY 1, 2),
 r AS (SELECT user_id, seg, ac/abs(dc) AS r FROM s) SELECT user_id, round(stddev_pop(r)/avg(r),6) AS cv, round(max(r)-min(r),6) AS spread, round(max(r) FILTER (WHERE seg=2)-max(r) FILTER (WHERE seg=0),6) AS half_delta FROM r GROUP BY 1""")
def segment_acdc(spark, sf_dir):
    n = events(spark, sf_dir).withColumn("n", F.count(F.lit(1)).over(_U())).withColumn("seg", series.segment_id(F.col("i"), F.col("n"), 3))
    g = Window.partitionBy("user_id", "seg")
    s = n.withColumn("dc", F.percentile("value", F.lit(0.5)).over(g)).groupBy("user_id", "seg").agg(F.first("dc").alias("dc"), F.percentile(F.abs(F.col("value") - F.col("dc")), F.lit(0.5)).alias("ac"))
    r = s.withColumn("r", F.try_divide(F.col("ac"), F.abs("dc")))
    return r.groupBy("user_id").agg(F.round(F.stddev_pop("r") / F.avg("r"), 6).alias("cv"), F.round(F.max("r") - F.min("r"), 6).alias("spread"), F.round(F.max(F.when(F.col("seg") == 2, F.col("r"))) - F.max(F.when(F.col("seg") == 0, F.col("r"))), 6).alias("half_delta"))


@query(f"""WITH {V_SQL}, c AS (SELECT vec_id, pos, x, x*x AS y FROM v), p AS (SELECT a.vec_id, l.lag, sum(a.x*b.y) AS s, sum(a.x*a.x) AS sx, sum(b.y*b.y) AS sy FROM c a JOIN (SELECT unnest(range(-3,4)) AS lag) l ON true JOIN c b ON a.vec_id=b.vec_id AND b.pos=a.pos+l.lag GROUP BY 1, 2)
 SELECT vec_id, round(max(abs(s/sqrt(sx*sy))),6) AS peak FROM p GROUP BY 1""")
def lagged_xcorr_peak(spark, sf_dir):
    c = vectors(spark, sf_dir).withColumn("y", F.col("x") * F.col("x"))
    p = series.lag_products(c, "vec_id", "pos", "x", "y", list(range(-3, 4)))
    return p.groupBy("vec_id").agg(F.round(F.max(F.abs(F.try_divide(F.col("s"), F.sqrt(F.col("sx") * F.col("sy"))))), 6).alias("peak"))


@query(f"""WITH {V_SQL}, c AS (SELECT vec_id, pos, x-avg(x) OVER (PARTITION BY vec_id) AS x FROM v), z AS (SELECT vec_id, sum(x*x) AS r0 FROM c GROUP BY 1), p AS (SELECT a.vec_id, l.lag, sum(a.x*b.x) AS s FROM c a JOIN (SELECT unnest(range(8,38)) AS lag) l ON true JOIN c b ON a.vec_id=b.vec_id AND b.pos=a.pos+l.lag GROUP BY 1, 2)
 SELECT vec_id, round(max(s)/max(r0),6) AS peak FROM p JOIN z USING (vec_id) GROUP BY 1""")
def autocorr_peak(spark, sf_dir):
    v = table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("a"))
    return v.select("vec_id", F.round(spectral.autocorrelation_peak(v, F.col("a"), 8, 37), 6).alias("peak"))


_SPEC = V_SQL + """, h AS (SELECT vec_id, pos, (x-avg(x) OVER (PARTITION BY vec_id))*(0.54::DOUBLE-0.46::DOUBLE*cos(2*pi()*pos/63)) AS v FROM v),
 s AS (SELECT vec_id, k, sqrt(pow(sum(v*cos(2*pi()*k*pos/256)),2)+pow(sum(v*sin(2*pi()*k*pos/256)),2)) AS mag FROM h, (SELECT unnest(range(6,52)) AS k) GROUP BY 1, 2)"""


@query(f"WITH {_SPEC} SELECT vec_id, round(sum(mag*mag) FILTER (WHERE k BETWEEN 8 AND 30)/sum(mag*mag),6) AS band_ratio, round(max(mag)/median(mag),5) AS peak_ratio, arg_max(k, mag)*25.0::DOUBLE/256 AS dominant_hz FROM s GROUP BY 1")
def dft_band_power(spark, sf_dir):
    s = spectral.spectrum(vectors(spark, sf_dir), "vec_id", "pos", "x", 64)
    p = F.col("magnitude") * F.col("magnitude")
    return s.groupBy("vec_id").agg(F.round(safe_div(F.sum(F.when(F.col("k").between(8, 30), p)), F.sum(p)), 6).alias("band_ratio"), F.round(F.max("magnitude") / F.percentile("magnitude", F.lit(0.5)), 5).alias("peak_ratio"), (F.max_by("k", "magnitude") * F.lit(25.0) / 256).alias("dominant_hz"))


@query(f"WITH {_SPEC}, p AS (SELECT vec_id, mag*mag/sum(mag*mag) OVER (PARTITION BY vec_id) AS p FROM s) SELECT vec_id, round(-sum(p*ln(p))/ln(46),6) AS entropy FROM p GROUP BY 1")
def spectral_entropy(spark, sf_dir):
    s = spectral.spectrum(vectors(spark, sf_dir), "vec_id", "pos", "x", 64)
    p = F.col("magnitude") * F.col("magnitude")
    q = s.select("vec_id", (p / F.sum(p).over(Window.partitionBy("vec_id"))).alias("p"))
    return q.groupBy("vec_id").agg(F.round(-F.sum(F.when(F.col("p") > 0, F.col("p") * F.ln("p"))) / F.ln(F.lit(46.0)), 6).alias("entropy"))


@query(f"WITH {_SPEC}, r AS (SELECT k, avg(mag*mag) AS m FROM s GROUP BY 1) SELECT vec_id, round(sum(mag*mag*m)/sqrt(sum(pow(mag,4))*sum(m*m)),6) AS cosine FROM s JOIN r USING (k) GROUP BY 1")
def spectral_cosine(spark, sf_dir):
    s = spectral.spectrum(vectors(spark, sf_dir), "vec_id", "pos", "x", 64).withColumn("p", F.col("magnitude") * F.col("magnitude"))
    r = s.groupBy("k").agg(F.avg("p").alias("m"))
    j = s.join(r, "k").groupBy("vec_id").agg(F.sum(F.col("p") * F.col("m")).alias("a"), F.sum(F.col("p") * F.col("p")).alias("b"), F.sum(F.col("m") * F.col("m")).alias("c"))
    return j.select("vec_id", F.round(F.col("a") / F.sqrt(F.col("b") * F.col("c")), 6).alias("cosine"))


@query(f"WITH {E_SQL}, b AS (SELECT user_id, covar_pop(value, i)/var_pop(i) AS beta, avg(i) AS mi FROM e GROUP BY 1) SELECT e.user_id, e.i, round(value-beta*(i-mi),6) AS residual FROM e JOIN b USING (user_id)")
def projection_residual(spark, sf_dir):
    """A linear component of another channel removed by its regression weight."""
    beta = F.coalesce(F.try_divide(F.covar_pop("value", "i").over(_U()), F.var_pop("i").over(_U())), F.lit(0.0))
    return events(spark, sf_dir).select("user_id", "i", F.round(F.col("value") - beta * (F.col("i") - F.avg("i").over(_U())), 6).alias("residual"))


@query(f"WITH {E_SQL} SELECT user_id, round(regr_slope(value, i),6) AS slope, round(regr_intercept(value, i),6) AS intercept FROM e GROUP BY 1")
def linear_trend(spark, sf_dir):
    return events(spark, sf_dir).groupBy("user_id").agg(F.round(F.regr_slope("value", "i"), 6).alias("slope"), F.round(F.regr_intercept("value", "i"), 6).alias("intercept"))


@query(f"WITH {E_SQL}, r AS (SELECT user_id, value, row_number() OVER (PARTITION BY user_id ORDER BY value DESC) AS r, count(*) OVER (PARTITION BY user_id) AS n FROM e) SELECT user_id, round(avg(value),6) AS tail_mean FROM r WHERE r<=ceil(0.1*n) GROUP BY 1")
def tail_mean_top10pct(spark, sf_dir):
    r = events(spark, sf_dir).select("user_id", "value", F.row_number().over(_U().orderBy(F.desc("value"))).alias("r"), F.count(F.lit(1)).over(_U()).alias("n"))
    return r.where(F.col("r") <= F.ceil(F.col("n") * 0.1)).groupBy("user_id").agg(F.round(F.avg("value"), 6).alias("tail_mean"))


@query("""WITH x AS (SELECT vec_id, [list_sum(list_transform(embedding[1:21], lambda v: v::DOUBLE*v)), list_sum(list_transform(embedding[22:42], lambda v: v::DOUBLE*v)), list_sum(list_transform(embedding[43:63], lambda v: v::DOUBLE*v))] AS z FROM embeddings),
 p AS (SELECT vec_id, z, [z[1]+z[2], z[2]+z[3], z[3]+z[1]] AS s FROM x) SELECT vec_id, round(list_max(s),6) AS best, len(list_filter(s, lambda v: list_max(s)-v <= 1e-9*list_max(s))) AS n_pairs, round(list_max(s)/list_sum(z),6) AS share FROM p""")
def top2_pair_composite(spark, sf_dir):
    """Best pair of three zones by energy; near-equal pairs count together."""
    a = F.col("embedding").cast("array<double>")
    energy = lambda lo: F.aggregate(F.slice(a, lo, 21), F.lit(0.0), lambda acc, v: acc + v * v)
    x = table(spark, sf_dir, "embeddings").select("vec_id", F.array(energy(1), energy(22), energy(43)).alias("z"))
    z = F.col("z")
    x = x.withColumn("s", F.array(z[0] + z[1], z[1] + z[2], z[2] + z[0])).withColumn("top", F.array_max("s"))
    near = F.size(F.filter("s", lambda v: F.col("top") - v <= F.greatest(1e-9 * F.col("top"), F.lit(1e-12))))
    return x.select("vec_id", F.round("top", 6).alias("best"), near.cast("long").alias("n_pairs"), F.round(F.col("top") / (z[0] + z[1] + z[2]), 6).alias("share"))


@query(f"WITH {E_SQL}, r AS (SELECT min(value) AS lo, max(value) AS hi FROM e), b AS (SELECT user_id, least(cast(floor((value-lo)/(hi-lo)*10) AS INT), 9) AS b, count(*) AS n FROM e, r GROUP BY 1, 2), p AS (SELECT user_id, n/sum(n) OVER (PARTITION BY user_id) AS p FROM b) SELECT user_id, round(-sum(p*ln(p)),6) AS entropy FROM p GROUP BY 1")
def histogram_entropy(spark, sf_dir):
    e = events(spark, sf_dir)
    r = e.agg(F.min("value").alias("lo"), F.max("value").alias("hi")).first()
    b = F.least(F.floor((F.col("value") - r["lo"]) / (r["hi"] - r["lo"]) * 10), F.lit(9))
    n = e.groupBy("user_id", b.alias("b")).agg(F.count(F.lit(1)).alias("n"))
    p = n.select("user_id", (F.col("n") / F.sum("n").over(_U())).alias("p"))
    return p.groupBy("user_id").agg(F.round(-F.sum(F.col("p") * F.ln("p")), 6).alias("entropy"))


@query("SELECT event_id, greatest(0.5::DOUBLE, 1-0.5::DOUBLE*least(greatest(value/200,0),1)) AS quality FROM events")
def quality_multiplier(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", quality_soft(F.col("value") / 200).alias("quality"))


_EMA_SQL = """r AS (SELECT user_id, i, prob FROM e), m AS (SELECT user_id, i, prob AS score, 0 AS state, CASE WHEN prob>0.45 THEN 1 ELSE 0 END AS on_n, 0 AS off_n, 1000 AS steps FROM r WHERE i=0
 UNION ALL SELECT n.user_id, n.i, n.score, CASE WHEN n.turn_on THEN 1 WHEN n.turn_off THEN 0 ELSE n.state END, CASE WHEN n.turn_on OR n.turn_off THEN 0 ELSE n.on_n END, CASE WHEN n.turn_on OR n.turn_off THEN 0 ELSE n.off_n END, CASE WHEN n.turn_on OR n.turn_off THEN 0 ELSE n.steps END
 FROM (SELECT *, state=0 AND on_n>=2 AND steps>=3 AS turn_on, state=1 AND off_n>=2 AND steps>=3 AS turn_off FROM (
  SELECT r.user_id, r.i, 0.4::DOUBLE*r.prob+(1-0.4::DOUBLE)*m.score AS score, m.state, CASE WHEN m.state=0 THEN CASE WHEN 0.4::DOUBLE*r.prob+(1-0.4::DOUBLE)*m.score>0.45 THEN m.on_n+1 ELSE greatest(m.on_n-1,0) END ELSE m.on_n END AS on_n,
   CASE WHEN m.state=1 THEN CASE WHEN 0.4::DOUBLE*r.prob+(1-0.4::DOUBLE)*m.score<0.35 THEN m.off_n+1 ELSE greatest(m.off_n-1,0) END ELSE m.off_n END AS off_n, m.steps+1 AS steps
  FROM m JOIN r ON r.user_id=m.user_id AND r.i=m.i+1)) n)"""


def _machine(spark, sf_dir):
    s = state.ordered_series(events(spark, sf_dir), ["user_id"], ["i"], "prob", "label")
    lit = F.lit
    return s.withColumn("m", state.run_machine(F.col("series"), "prob", lit(0.45), lit(0.35), lit(2), lit(2), lit(3), lit(0.4)))


@query(f"WITH RECURSIVE {E_SQL}, {_EMA_SQL} SELECT user_id, i::INT AS i, round(score,9) AS score, state FROM m")
def state_machine_trace(spark, sf_dir):
    """Score and state after every row of every series."""
    t = _machine(spark, sf_dir).select("user_id", F.posexplode(F.arrays_zip(F.col("m.scores").alias("score"), F.col("m.trace").alias("state"))).alias("i", "x"))
    return t.select("user_id", "i", F.round("x.score", 9).alias("score"), "x.state")


@query(f"WITH RECURSIVE {E_SQL}, {_EMA_SQL}, f AS (SELECT user_id, i, state, lag(state,1,0) OVER (PARTITION BY user_id ORDER BY i) AS b FROM m) SELECT user_id, sum(CASE WHEN state<>b THEN 1 ELSE 0 END)::BIGINT AS flips, coalesce(min(i) FILTER (WHERE state=1),-1)::BIGINT AS first_on, sum(state)::BIGINT AS on_rows FROM f GROUP BY 1")
def state_flips_first_hit(spark, sf_dir):
    t = F.col("m.trace")
    before = F.concat(F.array(F.lit(0)), F.slice(t, F.lit(1), F.size(t) - 1))
    count = lambda a: F.aggregate(a, F.lit(0).cast("long"), lambda s, v: s + v)
    return _machine(spark, sf_dir).select("user_id", count(F.zip_with(t, before, lambda a, b: F.abs(a - b))).alias("flips"), (F.array_position(t, 1) - 1).cast("long").alias("first_on"), count(t).alias("on_rows"))


@query(f"WITH RECURSIVE {E_SQL}, {_EMA_SQL}, j AS (SELECT e.split, e.label, m.state, m.i FROM m JOIN e ON e.user_id=m.user_id AND e.i=m.i WHERE m.i>=5), g AS (SELECT split, count(*) FILTER (WHERE label=1 AND state=1) AS tp, count(*) FILTER (WHERE label=0 AND state=1) AS fp, count(*) FILTER (WHERE label=0 AND state=0) AS tn, count(*) FILTER (WHERE label=1 AND state=0) AS fn FROM j GROUP BY 1) SELECT * FROM g")
def replay_metrics_with_warmup(spark, sf_dir):
    """Stream confusion of the machine's states; the first five rows of a series are hidden, not skipped."""
    from kymo.functions.exprs import confusion
    from kymo.plans.base import split_of

    t = _machine(spark, sf_dir).select("user_id", F.posexplode(F.arrays_zip(F.col("m.trace").alias("state"), F.col("series.label").alias("label"))).alias("i", "x"))
    return t.where("i >= 5").select(split_of("user_id").alias("split"), "x.*").groupBy("split").agg(*confusion(F.col("label"), F.col("state")))


@query(f"""WITH RECURSIVE {E_SQL}, g AS (SELECT unnest([0,1,2]) AS pid, unnest([0.3::DOUBLE,0.4::DOUBLE,0.5::DOUBLE]) AS alpha, unnest([0.4::DOUBLE,0.45::DOUBLE,0.5::DOUBLE]) AS t_on), m AS (SELECT g.pid, g.alpha, g.t_on, user_id, i, prob AS score, CASE WHEN prob>g.t_on THEN 1 ELSE 0 END AS hits FROM e, g WHERE i=0
 UNION ALL SELECT m.pid, m.alpha, m.t_on, e.user_id, e.i, m.alpha*e.prob+(1-m.alpha)*m.score, CASE WHEN m.alpha*e.prob+(1-m.alpha)*m.score>m.t_on THEN 1 ELSE 0 END FROM m JOIN e ON e.user_id=m.user_id AND e.i=m.i+1)
 SELECT pid, sum(hits)::BIGINT AS hits, count(DISTINCT user_id) FILTER (WHERE hits=1) AS users FROM m GROUP BY 1""")
def postprocess_grid_metrics(spark, sf_dir):
    """A parameter grid replayed over every series: each series row carries the grid, so nothing is shuffled per parameter."""
    params = F.array(*[F.struct(F.lit(k).alias("pid"), F.lit(a).alias("alpha"), F.lit(t).alias("t_on")) for k, a, t in ((0, 0.3, 0.4), (1, 0.4, 0.45), (2, 0.5, 0.5))])
    s = state.ordered_series(events(spark, sf_dir), ["user_id"], ["i"], "prob").withColumn("p", F.explode(params))
    m = state.run_machine(F.col("series"), "prob", F.col("p.t_on"), F.lit(0.35), F.lit(2), F.lit(2), F.lit(3), F.col("p.alpha"))
    hits = F.size(F.filter(m["scores"], lambda x: x > F.col("p.t_on"))).cast("long")
    return s.select(F.col("p.pid").alias("pid"), hits.alias("h")).groupBy("pid").agg(F.sum("h").alias("hits"), F.count(F.when(F.col("h") > 0, 1)).alias("users"))


@query("SELECT strftime(time_bucket(INTERVAL '1 hour', ts), '%Y-%m-%d %H:00') AS hour_start, event_type, count(*) AS n, round(sum(value),4) AS total FROM events GROUP BY 1, 2")
def stream_equals_batch_windows(spark, sf_dir):
    """Event-time windows with a watermark, as a stream that reads what is there and stops; written to the shared store."""
    from kymo.streaming.windows import hourly_counts

    return hourly_counts(spark, f"{sf_dir}/events.parquet")
