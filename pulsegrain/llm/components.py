"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrain.llm.shared import written


def _stars(edges: DataFrame) -> DataFrame:
    """One large star and one small star over edges (a, b), a > b."""
    both = edges.select("a", "b").union(edges.select(F.col("b"), F.col("a")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select(
        "a", F.least("a", "m").alias("m"))
    large = (both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
             .where("a <> b"))
    least = large.groupBy("a").agg(F.min("b").alias("m"))
    joined = large.join(least, "a")
    return (joined.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .union(least.select("a", F.col("m").alias("b"))).distinct())


def smallest_reachable(links: DataFrame) -> DataFrame:
    """node, component for each end of a link (a, b): the smallest node that it reaches.

    Every round is written; all that comes to the driver is a count and a checksum. A hub is
    reduced to its minimum before each shuffle and joined as one key, which adaptive execution
    can split.
    """
    edges = written(links.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    state = None
    while True:
        row = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(row) == state:
            break
        state = tuple(row)
        edges = written(_stars(edges), "stars")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
