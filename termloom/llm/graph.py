"""Connected components of an edge table by alternating large-star and small-star steps, distributed throughout.

Each step is one shuffle by node.  A hub's neighbours are never gathered: only the smallest is taken by a
partial aggregation, then joined back, so the join can be split if the hub is hot.  The edges are written to the
shared folder after each round, which cuts the lineage and survives lost executors; the round before is deleted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termloom.llm.shared import discard, written


def components(spark: SparkSession, edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component) for each node of edges (a, b); component is its smallest node. Nulls and loops are ignored."""
    links = edges.filter("a is not null and b is not null and a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    links = written(spark, links, "edges")
    for _ in range(max_rounds):
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        # large star: each larger neighbour gets the least of the neighbourhood
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        # small star: each smaller neighbour, and the node itself, gets the least of them
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(low.select("a", F.col("m").alias("b"))).distinct()
        after = written(spark, small.filter("a <> b"), "edges")
        # done when there are stars only: no node is both a leaf and a centre, and each leaf has one centre
        roles = after.select(F.col("a").alias("node"), F.lit(1).alias("leaf"), F.lit(0).alias("centre")).unionByName(after.select(F.col("b").alias("node"), F.lit(0).alias("leaf"), F.lit(1).alias("centre")))
        tangled = roles.groupBy("node").agg(F.sum("leaf").alias("leaf"), F.max("centre").alias("centre")).filter("leaf > 1 or (leaf = 1 and centre = 1)").limit(1).count()
        discard(spark, links)
        links = after
        if not tangled:
            break
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
