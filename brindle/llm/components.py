"""Connected components of a graph by alternating large-star and small-star steps on DataFrames.

Only per-node minima are aggregated, with map-side combination, and joined back, so a hub's edges are never
gathered in one task: Spark splits the skewed side of those joins. No edge reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brindle.llm.work import discard, materialize

#: The steps end far earlier: their number grows with the logarithm of the longest path. If they don't, that is an error.
MAX_STEPS = 100


def _star(edges: DataFrame, both_ways: bool) -> DataFrame:
    """One step on edges (u, v) with u > v. Large-star (both ways) joins each larger neighbour of a node to
    the smallest of its neighbours and itself; small-star joins a node and its smaller neighbours to the smallest."""
    arcs = edges
    if both_ways:
        arcs = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = arcs.groupBy(F.col("u").alias("m_u")).agg(F.min("v").alias("low"))
    met = arcs.join(least, F.col("u") == F.col("m_u"))
    if both_ways:
        out = met.where("v > u").select(F.col("v").alias("u"), F.least("low", "u").alias("v"))
    else:
        out = met.select(F.col("v").alias("u"), F.col("low").alias("v")).unionByName(least.select(F.col("m_u").alias("u"), F.col("low").alias("v")))
    return out.where("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node on an edge: ``root`` is the smallest node of its component. ``edges``: (a, b)."""
    current = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    seen = None
    for _ in range(MAX_STEPS):
        before, current = current, materialize(_star(_star(current, True), False), "star", small=True)
        discard(before)
        state = current.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
    else:
        raise RuntimeError(f"components still change after {MAX_STEPS} steps")
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return current.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
