"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.session import checkpointed


def _unsettled(pairs: DataFrame) -> bool:
    """True while some node has two roots or some root has a root of its own."""
    several = pairs.groupBy("u").agg(F.count("*").alias("n")).where("n > 1").select("u")
    below = pairs.select(F.col("v").alias("u")).join(pairs.select("u"), "u", "left_semi")
    return not several.unionByName(below).isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of `edges` (u long, v long): the smallest node that edges reach.

    Alternates two steps until nothing changes: every node's larger neighbours are tied to its smallest neighbour, then
    its smaller neighbours and itself are. Each step takes minima by aggregation and joins them back, so a node with very
    many edges is not gathered in one place, and the number of rounds grows with the logarithm of the longest path.
    """
    pairs = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    pairs = checkpointed(pairs)
    while _unsettled(pairs):
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("low"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("low").alias("v"))
        tied = low.select("u", F.col("low").alias("v"))
        tied = large.unionByName(tied).where("u <> v").distinct()
        low = tied.groupBy("u").agg(F.min("v").alias("low"))
        small = tied.join(low, "u").select(F.col("v").alias("u"), F.col("low").alias("v"))
        pairs = checkpointed(small.unionByName(low.select("u", F.col("low").alias("v"))).where("u <> v").distinct())
    roots = pairs.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
