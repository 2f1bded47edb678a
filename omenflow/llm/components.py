"""Connected components by alternating large and small stars; each round is written to the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import salted_join, stored


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` for all nodes of ``a, b`` (longs): the smallest node that links reach.

    A node is always joined by its key with a row of its own, never gathered with its neighbours; a hub's edges are
    pre-aggregated to a minimum, and dealt over salts where they meet it.  No edges give no rows; loops and repeated edges don't matter.
    """

    def both(e):
        return e.select("a", "b").unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))

    def star(e, large: bool):
        """Large: hang each larger neighbour on the least of the neighbourhood; small: the smaller ones and the node."""
        around = both(e) if large else e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = around.groupBy("a").agg(F.min(F.least("a", "b")).alias("m"), F.count("*").alias("_n"))
        tied = salted_join(around, least, "a", how="inner")
        if large:
            return tied.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        return tied.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b"))).where("a <> b")

    edges = stored(edges.select("a", "b").where("a <> b").distinct())
    before = None
    while True:
        edges = stored(star(star(edges, True).distinct(), False).distinct())
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    leaves = edges.groupBy("a").agg(F.min("b").alias("component")).select(F.col("a").alias("node"), "component")
    return leaves.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()).groupBy("node").agg(F.min("component").alias("component"))
