"""Connected components by alternating large-star and small-star rounds, on DataFrames only.

Defined cases: loops and repeated edges change nothing, a null end is no edge;
a node without edges is not returned; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kymo.llm.common import heavy_join
from kymo.session import cut, gathered


def components(edges: DataFrame, max_rounds: int = 60, rows: int | None = None) -> DataFrame:
    """``node, component`` for every node of ``edges(a, b)``; the component is its smallest node.

    Every round is written to the shared scratch store.  Rounds end when the
    edges form stars; their number grows with the logarithm of a component.
    A hub's edges are joined where they are, not gathered by their node.
    ``rows`` is the number of edges, where it is known.
    """
    kind = edges.schema["a"].dataType
    state = _directed(edges.select(F.col("a").cast(kind), F.col("b").cast(kind)))
    state = cut(state if rows is None else gathered(state, rows), "edges")
    before = _print(state)
    for k in range(max_rounds):
        large = cut(gathered(_large_star(state, before[0]), before[0]), f"large{k}")
        state = cut(gathered(_small_star(large, before[0]), 2 * before[0]), f"small{k}")
        now = _print(state)
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    leaves = state.select(F.col("hi").alias("node"), F.col("lo").alias("component"))
    return leaves.unionByName(state.select(F.col("lo").alias("node"), F.col("lo").alias("component")).distinct())


def _print(state: DataFrame) -> tuple:
    """Number of edges and a sum of their hashes."""
    return tuple(state.agg(F.count(F.lit(1)), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first())


def _directed(edges: DataFrame) -> DataFrame:
    return edges.where("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct()


def _relink(pairs: DataFrame, lowest: DataFrame, total: int) -> DataFrame:
    joined = heavy_join(pairs, lowest, ["u"], "n", total)
    return joined.select(F.col("v").alias("hi"), F.col("m").alias("lo")).where("hi <> lo").distinct()


def _large_star(state: DataFrame, total: int) -> DataFrame:
    """Every node's larger neighbours move to its smallest neighbour (or itself)."""
    both = state.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(state.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
    lowest = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), F.count(F.when(F.col("v") > F.col("u"), 1)).alias("n"))
    return _relink(both.where("v > u"), lowest, total)


def _small_star(state: DataFrame, total: int) -> DataFrame:
    """Every node and its smaller neighbours move to the smallest of them."""
    down = state.select(F.col("hi").alias("u"), F.col("lo").alias("v"))
    lowest = down.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n"))
    self_links = lowest.select(F.col("u").alias("hi"), F.col("m").alias("lo"))
    return _relink(down, lowest, total).unionByName(self_links).where("hi <> lo").distinct()
