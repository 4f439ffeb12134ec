"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brinkcast.llm.storage import stored


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    hung = down.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return hung.union(least.select("a", F.col("m").alias("b")))


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges`` (a, b: long) to (node, component): the smallest node reachable.

    Nodes without an edge to another node do not appear.  Every round keeps the
    components and shrinks distances; it ends when a round changes nothing.
    Only a count and a checksum come to the driver.
    """
    now = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = None
    while True:
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            roots = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)
        before = state
        now = stored(_small_star(_large_star(now).distinct()).distinct(), "stars")
