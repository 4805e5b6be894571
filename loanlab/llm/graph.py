"""Connected components of a link table by alternating large-star and small-star steps."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanlab.llm.text import broadcast_if_small, reliable


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node that has a link; root is the smallest node reachable.

    ``links`` has long columns a, b.  Each step is an aggregation and a join on the node;
    edges never leave Spark, and each round is written to the shared checkpoint folder.
    """
    edges = reliable(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct())
    before = None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = reliable(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
        large = reliable(both.where("v > u").join(broadcast_if_small(low, 64), "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct())
        low = reliable(large.groupBy("u").agg(F.min("v").alias("m")))
        small = large.join(broadcast_if_small(low, 64), "u")
        edges = reliable(small.select(F.col("v").alias("u"), F.col("m").alias("v")).union(small.select("u", F.col("m").alias("v"))).where("u <> v").distinct())
        # a fixed point is a set of stars: equal edge sets have equal counts and checksums
        now = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        if now == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        before = now
