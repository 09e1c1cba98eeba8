"""Connected components over an edge table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardgrain.llm.common import discard, materialize


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")))
                 .first())


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) for every node with an edge to another node; root is the
    smallest node of its component.

    Every round points each node at the smallest node next to it (first among
    all neighbours, then among the smaller ones) and writes the contracted
    edges into the shared folder; a round needs only per-node minima and
    equi-joins on a node, which AQE splits where a hub has many edges. Ends
    when a round changes nothing: O(log n) rounds on chains, 2-3 on stars.
    Null ends are ignored.
    """
    e = (edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
         .where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("u") != F.col("v")))
         .distinct())
    e = materialize(e, "edges")
    state = _state(e)
    while state[0]:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = (both.where("v > u").join(low, "u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        first = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(first, "u").where("v <> m")
                 .select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(first.select("u", F.col("m").alias("v"))).distinct())
        nxt = materialize(small, "edges")
        before, state = state, _state(nxt)
        discard(e)
        e = nxt
        if state == before:
            break
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
