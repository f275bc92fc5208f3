"""Connected components of a large graph by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.llm.common import Staged


def components(staged: Staged, edges: DataFrame, name: str) -> DataFrame:
    """node, component (its smallest node) of every node that has an edge to another; columns of `edges`: a, b.

    Both steps aggregate a node's neighbours to their smallest, so a node with very many neighbours is summed up
    before the shuffle and is never held in one task. Loops and repeated edges do not matter. Each step is written
    to the shared folder; the number of steps grows with the logarithm of the longest chain.
    """
    current = staged.write(f"{name}-0", edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    step, before = 0, None
    while True:
        step += 1
        both = current.union(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        # Every larger neighbour is hung on the smallest; a smallest node is hung on nothing.
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = staged.write(f"{name}-{step}-large", large)
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
        current = staged.write(f"{name}-{step}", small.where("u <> v").distinct())
        state = current.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(state) == before:
            return current.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
                current.select(F.col("v").alias("node"), F.col("v").alias("component"))
            ).distinct()
        before = tuple(state)
