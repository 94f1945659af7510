"""Registry of queries with their SQL, and the fixture views they share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kymo.operators.series import numbered
from kymo.sources.tables import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function as a query under its name, with its SQL."""

    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE[f.__name__] = sql
        return f

    return add


def split_of(key: str):
    k = F.pmod(F.col(key), F.lit(20))
    return F.when(k < 14, "train").when(k < 17, "valid").otherwise("test")


#: SQL of the views below.
E_SQL = """e AS (SELECT user_id, event_id, ts, event_type, value, props, value/(value+50.0::DOUBLE) AS prob,
  CASE WHEN event_type IN ('purchase','signup') THEN 1 ELSE 0 END AS label,
  row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id)-1 AS i,
  CASE WHEN user_id%20<14 THEN 'train' WHEN user_id%20<17 THEN 'valid' ELSE 'test' END AS split FROM events)"""
W_SQL = E_SQL + """, w AS (SELECT e.user_id, g.wid, min(split) AS split, count(*) AS n, median(value) AS med, avg(prob) AS prob, max(label) AS any_label,
  CASE WHEN avg(label) >= 0.5 THEN 1 ELSE 0 END AS label, CASE WHEN avg(prob) >= 0.5 THEN 1 ELSE 0 END AS pred
  FROM e JOIN (SELECT unnest(generate_series(0, (SELECT max(i)//5 FROM e))) AS wid) g ON e.i BETWEEN g.wid*5 AND g.wid*5+19
  GROUP BY e.user_id, g.wid HAVING count(*) = 20)"""
L_SQL = """l AS (SELECT l_orderkey, l_linenumber, l_suppkey, CASE WHEN l_returnflag='R' THEN 1 ELSE 0 END AS label,
  CASE WHEN l_orderkey%20<14 THEN 'train' WHEN l_orderkey%20<17 THEN 'valid' ELSE 'test' END AS split,
  l_quantity AS quantity, l_extendedprice AS price, l_discount AS discount, l_tax AS tax, l_shipdate FROM lineitem)"""
LF_SQL = L_SQL + """, lf AS (UNPIVOT (SELECT l_orderkey, l_suppkey, label, split, quantity, price, discount, tax FROM l) ON quantity, price, discount, tax INTO NAME feature VALUE value)"""
V_SQL = """v AS (SELECT vec_id, label, unnest(range(64))::INT AS pos, unnest(embedding)::DOUBLE AS x FROM embeddings)"""


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as an ordered signal per user: value, probability surrogate, label, split and index ``i``."""
    e = table(spark, sf_dir, "events")
    v = F.col("value")
    e = e.withColumn("prob", v / (v + 50.0)).withColumn("label", F.col("event_type").isin("purchase", "signup").cast("int")).withColumn("split", split_of("user_id"))
    return numbered(e, "user_id", ["ts", "event_id"])


def event_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows of 20 events, stride 5, with median, mean probability, label and prediction."""
    from kymo.operators.series import full_windows, sliding_windows

    rows = sliding_windows(events(spark, sf_dir).select("user_id", "split", "i", "value", "prob", "label"), 20, 5)
    w = full_windows(rows, ["user_id", "wid"], 20, F.min("split").alias("split"), F.percentile("value", F.lit(0.5)).alias("med"), F.avg("prob").alias("prob"), F.max("label").alias("any_label"), (F.avg("label") >= 0.5).cast("int").alias("label"))
    return w.withColumn("pred", (F.col("prob") >= 0.5).cast("int"))


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as four channels with a label and a split."""
    x = table(spark, sf_dir, "lineitem")
    return x.select(
        "l_orderkey", "l_linenumber", "l_suppkey", (F.col("l_returnflag") == "R").cast("int").alias("label"), split_of("l_orderkey").alias("split"),
        F.col("l_quantity").alias("quantity"), F.col("l_extendedprice").alias("price"), F.col("l_discount").alias("discount"), F.col("l_tax").alias("tax"), "l_shipdate",
    )


CHANNELS = ["quantity", "price", "discount", "tax"]


def line_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kymo.operators.metrics import long_features

    return long_features(lines(spark, sf_dir), ["l_orderkey", "l_suppkey", "label", "split"], CHANNELS)


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings as stored windows: one row per position, double precision."""
    v = table(spark, sf_dir, "embeddings")
    return v.select("vec_id", "label", F.posexplode(F.col("embedding").cast("array<double>")).alias("pos", "x"))
