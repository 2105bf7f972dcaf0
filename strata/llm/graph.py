"""Connected components of an edge table, by alternating star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from strata.llm.common import saved


def components(edges: DataFrame) -> DataFrame:
    """``edges`` has columns a, b. Returns node, component: the least node that
    each node reaches, for nodes with an edge.

    Each turn hangs every larger neighbour of a node on the node's least
    neighbour, then every smaller one; the edge set becomes a set of stars.
    Neighbourhoods are only ever reduced by ``min`` with partial aggregation,
    never collected. Every turn's edges are written to the shared folder."""
    e = saved(edges.where(F.col("a") != F.col("b"))
              .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    state = None
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (both.where(F.col("v") > F.col("u")).join(least, "u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")))
        large = large.where(F.col("u") != F.col("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        e = saved(small.select("u", F.col("m").alias("v"))
                  .unionByName(small.select(F.col("v").alias("u"), F.col("m").alias("v")))
                  .where(F.col("u") != F.col("v")).distinct(), "stars")
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if now == state:
            break
        state = now
    roots = e.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
