"""Connected components of a graph of any size by alternating large and small stars."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def components(edges: DataFrame, scratch) -> DataFrame:
    """(node, component) for every node that is not the smallest of its component.

    ``edges`` has long columns ``u`` and ``v``; loops and repeats do no harm. Each step joins
    a node's edges with its smallest neighbour. Both are tables that were written, so the
    join shuffles both and an overfull node is split at run time.
    """
    edges = scratch.keep(
        edges.where("u <> v")
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct()
    )
    while not _is_closed(edges):
        edges = _small_star(_large_star(edges, scratch), scratch)
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))


def _is_closed(edges) -> bool:
    """Whether every node has one edge at most and hangs directly on its component."""
    ends = edges.selectExpr("u as node", "1 as up", "0 as down").union(
        edges.selectExpr("v as node", "0 as up", "1 as down")
    )
    counts = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return counts.where("up > 1 or (up = 1 and down = 1)").isEmpty()


def _large_star(edges, scratch):
    """Every larger neighbour of a node moves to the node's smallest neighbour."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    least = scratch.keep(least.select("u", F.least("u", "m").alias("m")))
    moved = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.where("u <> v").distinct()


def _small_star(edges, scratch):
    """A node and its smaller neighbours all move to the smallest of them."""
    least = scratch.keep(edges.groupBy("u").agg(F.min("v").alias("m")))
    moved = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return scratch.keep(
        moved.union(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
    )
