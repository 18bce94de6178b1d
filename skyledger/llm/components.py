"""Connected components of an edge table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm.common import cut


def components(edges: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """(node, root) of every node that has an edge; the root is the least node.

    A large star links every greater neighbour of a node to the least one, a
    small star every lesser neighbour; both keep the components and end in
    stars around the least nodes. Edges only move through grouped minima and
    joins, so a node with very many edges is summed map-side and its join split.
    The rounds grow with the logarithm of the longest path.
    """
    a, b = F.col(left), F.col(right)
    now = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    now, before = cut(now), None
    while True:
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before or not state[0]:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
                now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            )
        before = state
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            small.select("u", F.col("m").alias("v"))
        )
        now = cut(small.where("u <> v").distinct())
