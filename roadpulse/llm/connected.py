"""Connected components by alternating stars, for links that no single task could hold."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadpulse.llm.common import stored


def _least(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("u").agg(F.min("v").alias("m"))


def components(links: DataFrame) -> DataFrame:
    """node and root (the smallest node that it reaches) for every node of ``links`` (a, b).

    Each round hangs the larger neighbours of a node, then the smaller ones, on the smallest
    neighbour. Rounds grow with the logarithm of the nodes; every round is written to the shared
    folder. Group-bys are pre-aggregated and joins carry long columns only, so a node with very
    many neighbours is split by the adaptive join. Null ends are ignored."""
    links = links.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    links = stored(links, "links")
    mark = None
    while True:
        now = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if not now[0] or tuple(now) == mark:
            # The stars stay as they are: every link leads from a node to its root.
            return links.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        mark = tuple(now)
        both = links.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
            links.select(F.col("b").alias("u"), F.col("a").alias("v")))
        larger = both.join(_least(both), "u").where("v > u").select(
            F.col("v").alias("u"), F.least("u", "m").alias("v")).where("u != v").distinct()
        larger = stored(larger, "links")
        least = _least(larger)
        smaller = larger.join(least, "u").where("v != m").select(F.col("v").alias("a"), F.col("m").alias("b"))
        links = stored(smaller.unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b"))).distinct(), "links")

