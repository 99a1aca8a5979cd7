"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from effortlens.llm.storage import written


def components(edges: DataFrame) -> DataFrame:
    """``vertex`` and ``label`` (the least vertex of its component) from long ``u`` and ``v``.

    A step joins each vertex's least neighbour back to its edges, so no neighbourhood is ever
    gathered; the number of steps grows with the logarithm of the longest path. Each step is
    written, which bounds the plan and survives lost executors.
    """
    found = written(_distinct(edges.filter("u <> v")), "edges")
    while True:
        smaller = written(_small_star(_large_star(found)), "stars")
        found = smaller
        if _unfinished(found).isEmpty():
            break
    leaves = found.select(F.col("v").alias("vertex"), F.col("u").alias("label"))
    return leaves.unionByName(
        found.select(F.col("u").alias("vertex"), F.col("u").alias("label")).distinct()
    )


def _unfinished(edges: DataFrame) -> DataFrame:
    """Vertices below two others, or below one and above another; none where all are stars."""
    ends = edges.select(F.col("v").alias("vertex"), F.lit(1).alias("below"), F.lit(0).alias("above"))
    ends = ends.unionByName(
        edges.select(F.col("u").alias("vertex"), F.lit(0).alias("below"), F.lit(1).alias("above"))
    )
    roles = ends.groupBy("vertex").agg(F.sum("below").alias("below"), F.max("above").alias("above"))
    return roles.filter("below > 1 or (below = 1 and above = 1)")


def _distinct(edges: DataFrame) -> DataFrame:
    """Each edge once, from its smaller vertex ``u`` to its greater one ``v``."""
    return edges.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    """Greater neighbours of each vertex are linked to its least neighbour, or itself."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = written(
        both.groupBy("u").agg(F.least("u", F.min("v")).alias("least")), "least-neighbours"
    )
    return _distinct(
        both.filter("v > u").join(least, "u").select("v", F.col("least").alias("u"))
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Each vertex and its smaller neighbours are linked to the least of these."""
    edges = written(edges, "large-stars")
    least = edges.groupBy("v").agg(F.min("u").alias("least"))
    linked = edges.join(least, "v").select(F.col("u").alias("v"), F.col("least").alias("u"))
    own = least.select("v", F.col("least").alias("u"))
    return _distinct(linked.unionByName(own).filter("u <> v"))
