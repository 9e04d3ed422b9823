"""Connected components of a link table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.llm.common import staged


def _neighbours_to_smallest(edges: DataFrame) -> DataFrame:
    """Large star: hang every larger neighbour of a node on the smallest of its neighbourhood."""
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _parents_to_smallest(edges: DataFrame) -> DataFrame:
    """Small star: hang a node and its smaller neighbours on the smallest of these."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    joined = edges.join(least, "u")
    moved = joined.filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node with a link; component is the smallest node reachable.

    Every round aggregates with map-side combine and is written to the shared scratch folder. No
    component meets in one task: a hub's rows are split by adaptive execution, as the other side of
    each join has one row per node. Self-links and repeated links have no effect.
    """
    pairs = edges.filter(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    seen, current = None, staged(pairs, "links")
    while True:
        state = current.agg(F.count("u"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen or state[0] == 0:
            break
        seen, current = state, staged(_parents_to_smallest(_neighbours_to_smallest(current)), "links")
    return current.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
