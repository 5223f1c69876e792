"""Connected components as DataFrame joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut


def components(edges: DataFrame) -> DataFrame:
    """node, root for every node of ``edges`` (a, b): alternating large-star
    and small-star steps until nothing changes; root is the least node of the
    component. Every step is a map-side combined minimum and a join on the
    node, and is cut by a reliable checkpoint; only a count and a checksum of
    the edges reach the driver."""
    e = cut(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct())
    seen = None
    while True:
        both = e.union(e.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.filter("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        joined = large.join(least, "a")
        e = cut(joined.select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b")
                .union(least.select("a", F.col("m").alias("b"))).distinct())
        state = e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen or not state[0]:
            break
        seen = state
    tails = e.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return tails.union(e.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
