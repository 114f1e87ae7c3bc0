"""Connected components of a graph given as edges, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankweave.runtime import stored

MAX_STEPS = 50


def _pointed(edges: DataFrame) -> DataFrame:
    """Edges from each node ``u`` (to smaller and larger ones, or smaller only) to their smallest end, without loops."""
    least = stored(edges.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m")), "least")
    return edges.join(least, "u")


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, root`` for each node of ``edges`` (two whole-number columns ``a`` and ``b``); the root is the smallest node.

    Each step is a sum by node and a join, and its edges are stored, so no node's neighbours are gathered anywhere. The
    number of steps grows with the logarithm of the longest path. Loops and repeated edges change nothing; no edges
    give no rows.
    """
    oriented = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    oriented = stored(oriented, "edges")
    before = None
    for _ in range(MAX_STEPS):
        both = oriented.unionByName(oriented.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _pointed(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large = stored(large, "edges")
        small = _pointed(large)
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).union(small.select("u", "m"))
        oriented = stored(small.where("u <> v").distinct(), "edges")
        now = oriented.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {MAX_STEPS} steps")
    return oriented.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        oriented.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
