"""Complete-link clusters of a sparse graph, by merging all pairs of reciprocal nearest neighbours in rounds."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.writers import forgotten, written
from . import matching


def complete_link(edges: DataFrame) -> DataFrame:
    """``a, b, height``: the merges of complete-link clustering, named by the clusters' smallest nodes (``a`` < ``b``).

    ``edges`` has ``a, b, d``: pairs without an edge are too far apart to be ever in one cluster, so that two clusters are joined
    only where each node of one has an edge to each of the other.  In a round all clusters that are each other's nearest
    merge; the distance of a merged cluster from another is the larger one, and gone where one of them had none
    (Lance and Williams).  As merging never brings clusters nearer to others, the merges are those of the pairwise
    order; of equal distances the edge with the smaller nodes comes first.  Loops and nulls don't count; of repeated edges the shortest does.
    A round's edges are deleted when the next round's are written.
    """
    e = edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), F.col("d").cast("double").alias("d"))
    e = written(e.where("a < b and d is not null").groupBy("a", "b").agg(F.min("d").alias("d")))
    merges = []
    while True:
        ends = F.array(F.struct(F.col("a").alias("node")), F.struct(F.col("b").alias("node")))
        order = F.struct("d", "a", "b")
        nearest = e.select(F.inline(ends), order.alias("edge")).groupBy("node").agg(F.min("edge").alias("edge"))
        # An edge that is the nearest of both its ends.
        both = nearest.groupBy("edge").agg(F.count("*").alias("n")).where("n = 2").select(F.col("edge.a").alias("a"), F.col("edge.b").alias("b"), F.col("edge.d").alias("height"))
        both = written(both)
        if both.isEmpty():
            break
        last = e
        merges.append(both)
        # Of each merged pair the smaller node stays; an edge of one is kept where the other has one to the same cluster.
        gone = both.select(F.col("b").alias("old"), F.col("a").alias("new"))
        size = both.select(F.col("a").alias("new"), F.lit(2).alias("size"))
        moved = e.join(both.select("a", "b"), ["a", "b"], "left_anti")
        for end in ("a", "b"):
            moved = moved.join(gone.withColumnRenamed("old", end), end, "left").withColumn(end, F.coalesce("new", end)).drop("new")
        for end in ("a", "b"):
            moved = moved.join(size.withColumnsRenamed({"new": end, "size": f"_{end}"}), end, "left")
        moved = moved.withColumn("_want", F.coalesce("_a", F.lit(1)) * F.coalesce("_b", F.lit(1)))
        pair = [F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")]
        e = written(moved.groupBy(*pair).agg(F.max("d").alias("d"), F.count("*").alias("n"), F.first("_want").alias("w")).where("n = w").select("a", "b", "d"))
        forgotten(last)
    if not merges:
        return e.select("a", "b", F.col("d").alias("height")).where("false")
    return reduce(DataFrame.unionByName, merges)


def cut(merges: DataFrame, nodes: DataFrame, height: float | None = None, clusters: int | None = None) -> DataFrame:
    """``node, cluster``: clusters below a height, or (as long as merges reach so far) a number of them."""
    kept = merges
    if clusters is not None:
        many = max(0, nodes.count() - clusters)
        kept = merges.orderBy("height", "a", "b").limit(many)
    elif height is not None:
        kept = merges.where(F.col("height") <= height)
    return matching.linked_groups(kept.select("a", "b"), nodes)
