"""Connected components of a table of links, by alternating large-star and small-star joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revstrata.llm.common import release, written


def components(links: DataFrame, a: str = "a", b: str = "b", rounds: int = 40) -> DataFrame:
    """(node, component) for every node with a link; the component is its smallest node.

    Each round is a few joins over the links and ends in a written table, so no lineage grows and no
    component is ever in one place. Loops and repeated links change nothing.
    """
    def star(edges: DataFrame, large: bool) -> DataFrame:
        ways = edges.select(F.col("a").alias("u"), F.col("b").alias("v")) if not large else edges.select("a", "b").unionAll(edges.select("b", "a")).toDF("u", "v")
        least = ways.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        near = ways.join(least, "u")
        moved = near.where(F.col("v") > F.col("u")) if large else near
        out = moved.select(F.greatest("v", "m").alias("a"), F.least("v", "m").alias("b"))
        if not large:
            out = out.unionAll(least.select(F.greatest("u", "m").alias("a"), F.least("u", "m").alias("b")))
        return out.where(F.col("a") != F.col("b")).distinct()

    edges = written(
        links.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).where(F.col("a") != F.col("b")).distinct(), "links"
    )
    sums = None
    for turn in range(rounds):
        edges = written(star(star(edges, True), False), "stars")
        if turn % 3 == 2:
            release(edges.sparkSession)
        now = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == sums:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionAll(edges.select("b", "b").distinct())
        sums = now
    raise RuntimeError(f"no fixed point after {rounds} rounds")
