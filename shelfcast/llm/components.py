"""Connected components of an edge table, by alternating stars.

Each round points every node's larger neighbours, and then the node itself, at its smallest
neighbour. Only minima are grouped, so a node with many neighbours is summed before the
shuffle; the joins on nodes are plain equi-joins that adaptive execution splits. The rounds
grow with the logarithm of the number of nodes; each is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.storage import stored


def _to_smallest(pairs: DataFrame) -> DataFrame:
    """(u, v, m): each pair with the smallest of u and all of its v."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m"))
    least = least.select(F.col("u").alias("u0"), F.least("u", "m").alias("m"))
    return pairs.join(least, pairs["u"] == least["u0"]).select("u", "v", "m")


def _round(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    large = _to_smallest(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    large = large.where("u != v").distinct()
    small = _to_smallest(large)
    small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).union(
        small.select("u", F.col("m").alias("v"))
    )
    return small.where("u != v").distinct()


def connected(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of the edges (u, v); the root is the smallest node."""
    low, high = F.least("u", "v"), F.greatest("u", "v")
    edges = edges.where("u != v").select(high.alias("u"), low.alias("v")).distinct()
    edges = stored(edges, "edges")
    seen = None
    while True:
        state = edges.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()
        if state[0] == 0 or state == seen:
            break
        seen = state
        edges = stored(_round(edges), "edges")
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)
