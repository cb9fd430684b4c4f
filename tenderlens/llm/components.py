"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import step


def _turned(edges: DataFrame) -> DataFrame:
    return edges.select(F.col("v").alias("u"), F.col("u").alias("v"))


def components(edges: DataFrame) -> DataFrame:
    """``(id, component)`` of each node of ``edges`` (u, v): the smallest id reachable. No list of neighbours is built.

    Each round joins a node's neighbours to the smallest one, so a node with a third of all edges costs one row of
    partial minima per task; its edges are split by the skew join. Rounds grow with the logarithm of the longest chain.
    """
    now = edges.where("u is not null and v is not null and u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    now = step(now.distinct(), "edges")
    mark = None
    while True:
        both = now.unionByName(_turned(now))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = step(large.where("u <> v"), "large-star")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(low, "u")
        small = joined.select(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v")).unionByName(low.select("u", F.col("m").alias("v")))
        now = step(small.where("u <> v").distinct(), "small-star")
        told = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(told) == mark:
            break
        mark = tuple(told)
    roots = now.select(F.col("v").alias("id")).distinct()
    return now.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(roots.select("id", F.col("id").alias("component")))
