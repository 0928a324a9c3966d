"""Connected components of an undirected graph that no single machine holds."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from docketrank.llm.common import shared_folder


def _nearest(pairs: DataFrame) -> DataFrame:
    """Pairs (a, b) with, for each a, the smallest of a and all its b."""
    least = pairs.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return pairs.join(least, "a")


def _large_star(edges: DataFrame) -> DataFrame:
    """Hang every larger neighbour of a node on the smallest node around it."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    return _nearest(both).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Hang the smaller neighbours of a node, and the node, on the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b")
    near = _nearest(down)
    own = near.select("a", F.col("m").alias("b"))
    return near.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(own)


def connected_components(edges: DataFrame) -> DataFrame:
    """Component of every node that has an edge: columns ``node`` and ``component``.

    ``edges`` has two id columns. Repeated edges, loops and NULL ends are allowed and change
    nothing. ``component`` is the smallest node reachable; a table without edges gives no row.

    Alternating large-star and small-star steps (Kiveris et al., 2014): minima are aggregated
    before the shuffle, a hub's edges join by key where AQE can split them, each round is
    checkpointed, and only two sums of the edge list come to the driver.
    """
    shared_folder(edges.sparkSession)
    first, second = edges.columns[:2]
    stars = edges.select(F.col(first).alias("a"), F.col(second).alias("b")).where("a <> b").distinct().checkpoint()
    before = None
    while True:
        now = stars.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            return stars.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
                stars.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            )
        before = now
        stars = _small_star(_large_star(stars)).distinct().checkpoint()
