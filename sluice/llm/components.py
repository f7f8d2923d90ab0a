"""Connected components of a link table by alternating stars, without the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def _unfinished(edges: DataFrame) -> bool:
    """Whether a node has several smaller neighbours, or a smaller and a larger one. Edges lead from the larger node to the smaller."""
    ends = edges.select(F.inline(F.array(F.struct(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")),
                                         F.struct(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))))
    return bool(ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down")).filter("up > 1 or up = 1 and down = 1").take(1))


def components(links: DataFrame) -> DataFrame:
    """(node, label) for every node of ``links`` (a, b: long): label is the smallest node reachable.

    Each round points the larger neighbours of a node at its smallest one, then does the same for the smaller
    neighbours, until all edges lead straight to the smallest node. Rounds grow with the logarithm of the longest chain. Minima are
    combined before the shuffle, and the join that hands them back is split by adaptive execution where a node is hot. Edges are made
    distinct once a round only, as neither half makes more of them than it reads and nodes it has.
    """
    edges = written(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct(), "links")
    while _unfinished(edges):
        both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        # large star: neighbours above the node go to its minimum, which is below them
        down = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        # small star: the lower neighbours and the node itself go to the minimum
        least = down.groupBy("a").agg(F.min("b").alias("m"))
        moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b")
        edges = written(moved.union(least.select("a", F.col("m").alias("b"))).distinct(), "stars")
    labels = edges.select(F.col("a").alias("node"), F.col("b").alias("label"))
    return labels.union(labels.select(F.col("label").alias("node"), "label").distinct())
