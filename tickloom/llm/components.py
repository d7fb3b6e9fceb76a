"""Connected components of a graph too large for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, saved


def components(edges: DataFrame) -> DataFrame:
    """(node, root): every node that has an edge, with the smallest node it can reach.

    `edges` is (a long, b long). Large-star and small-star steps alternate: each
    links nodes to the smallest neighbour, larger ones then smaller ones, and the
    number of steps grows with the logarithm of the longest path. Minima are
    combined before the shuffle, so a hub is no hot key for them; joins on a hub
    are split by adaptive execution. Each step is written to the shared folder,
    and what it was made from is removed.
    """
    edges = saved(
        edges.filter(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct()
    )
    before, given = None, edges
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.filter(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = saved(large.filter(F.col("u") != F.col("v")).distinct())
        # Every node points down by now: its smallest neighbour is the smallest of v.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        edges = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v"))
        )
        last, edges = given, saved(edges.filter(F.col("u") != F.col("v")).distinct())
        discard(last, large)
        given = edges
        now = edges.agg(F.count("u"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            roots = edges.select("v").distinct()
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                roots.select(F.col("v").alias("node"), F.col("v").alias("root"))
            )
        before = now
