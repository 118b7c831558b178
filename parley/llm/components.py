"""Connected components by alternating star operations, as DataFrame joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parley.llm.common import release, stash


def _mark(edges: DataFrame) -> tuple:
    r = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
    return r[0], r[1]


def star_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``(node, root)`` for every node of ``edges(u, v)`` (long): root is the smallest node of its component.

    Large-star then small-star per round, until the edges stay the same; the
    minima are map-side aggregates, so a hub with very many edges is reduced
    before its exchange.  The edges are written to the shared folder per round.
    """
    spark = edges.sparkSession
    edges = stash(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                  .distinct(), "star")
    mark = _mark(edges)
    for _ in range(max_rounds):
        if not mark[0]:
            break
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        # large star: every larger neighbour of u points to the smallest of u's neighbourhood
        large = (edges.select(F.col("v").alias("u"), F.col("u").alias("w")).join(low, "u")
                 .select(F.col("w").alias("u"), F.col("m").alias("v"))).where("u <> v").distinct()
        large = stash(large, "star")
        # small star: u and its smaller neighbours point to the smallest of them
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        small = (small.select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(least.select("u", F.col("m").alias("v")))).where("u <> v").distinct()
        edges = stash(small, "star")
        release(spark)
        now = _mark(edges)
        if now == mark:
            break
        mark = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    stars = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return stars.unionByName(stars.select(F.col("root").alias("node"), "root").distinct())
