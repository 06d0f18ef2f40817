"""Connected components of a graph that no single task or driver holds."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterlake.llm.common import Scratch


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """``node, component``: the smallest node reachable, for every node that has an edge.

    ``edges`` holds pairs ``a, b``. Alternates the large-star and the small-star step: every
    node hands its larger, then its smaller neighbours to the smallest one it knows. That
    takes a number of rounds that grows with the log of the longest path. The rows of one
    node's neighbours meet in one task, where a window takes their least and spills if need be.
    Each round is written, so a lost executor repeats one round.
    """
    both = Window.partitionBy("a")

    def large(e: DataFrame) -> DataFrame:
        turned = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = turned.withColumn("m", F.least(F.min("b").over(both), F.col("a")))
        return least.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))

    def small(e: DataFrame) -> DataFrame:
        down = e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = down.withColumn("m", F.min("b").over(both))
        own = least.select("a", F.col("m").alias("b"))
        handed = least.where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        return own.unionByName(handed).distinct()

    def size(e: DataFrame) -> tuple:
        mark = F.xxhash64("a", "b").cast("decimal(38,0)")
        return tuple(e.agg(F.count("*"), F.sum(mark)).first())

    now = scratch.store(edges.select("a", "b").where("a <> b").distinct())
    seen = size(now)
    while True:
        after = scratch.store(small(large(now)))
        scratch.drop(now)
        now, before, seen = after, seen, size(after)
        if seen == before:
            break
    labels = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return labels.unionByName(labels.select(F.col("component").alias("node"), "component")).distinct()
