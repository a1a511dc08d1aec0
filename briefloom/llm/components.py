"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import mark, release, stored


def _all_stars(edges: DataFrame) -> bool:
    """Whether every node with a smaller neighbour has that one neighbour only."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down"))
    ends = ends.unionByName(edges.select(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    per = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return per.filter("up > 1 or (up > 0 and down > 0)").isEmpty()


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of ``edges`` (a, b); component is its smallest node.

    Edges stay in Spark tables; no neighbour list is gathered, a node's least
    neighbour is an aggregate joined back, so a hub with a third of all edges is
    combined before the shuffle and split by adaptive joins.  Each round is
    written to the shared folder; rounds grow with the logarithm of the longest
    path, and end when only stars are left.  No edges give no rows.
    """
    since = mark()
    e = stored(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    while not _all_stars(e):
        both = e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy(F.col("a").alias("u")).agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.join(least, F.col("a") == F.col("u")).filter("b > u and b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"))
        small = large.join(low, F.col("a") == F.col("u")).filter("b <> m").select(F.greatest("b", "m").alias("a"), F.least("b", "m").alias("b")).union(low.select(F.col("u").alias("a"), F.col("m").alias("b"))).distinct()
        e = stored(small, "edges")
        release(since, e)
    # stars: every edge is (node, smallest node)
    return e.select(F.col("a").alias("node"), F.col("b").alias("component")).union(e.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
