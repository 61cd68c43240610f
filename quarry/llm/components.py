"""Connected components by alternating star contraction, as Spark joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import saved


def components(links: DataFrame, rounds: int = 64) -> DataFrame:
    """``node``, ``component`` (its component's smallest node) for the nodes of ``links`` (``src``, ``dst``).

    Each round points every node, and every neighbour, at the smallest node of
    its neighbourhood. Rounds grow with the logarithm of the longest path; each
    is written to the shared folder, so lineage stays short and a lost executor
    repeats one round at most. Nothing but a count of changes reaches the driver.
    """
    edges = saved(links.where(F.col("src") != F.col("dst")).select("src", "dst").distinct(), "links")
    if edges.isEmpty():
        return edges.select(F.col("src").alias("node"), F.col("dst").alias("component"))
    for _ in range(rounds):
        both = edges.union(edges.select("dst", "src")).toDF("u", "v")
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        # large star: a node's larger neighbours hang on the least of its neighbourhood
        large = both.where(F.col("v") > F.col("u")).join(least, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("src"), F.col("m").alias("dst")).distinct()
        large = saved(large, "large-star")
        # small star: a node and its smaller neighbours hang on the least of those
        down = large.groupBy("src").agg(F.min("dst").alias("m"))
        joined = large.join(down, "src")
        small = joined.where(F.col("dst") != F.col("m")).select(F.col("dst").alias("src"), F.col("m").alias("dst")).union(down.select("src", F.col("m").alias("dst"))).distinct()
        nxt = saved(small, "small-star")
        same = nxt.select(F.count("*").alias("n"), F.sum(F.xxhash64("src", "dst").cast("decimal(38,0)")).alias("h")).first() == edges.select(
            F.count("*").alias("n"), F.sum(F.xxhash64("src", "dst").cast("decimal(38,0)")).alias("h")
        ).first()
        edges = nxt
        if same:
            break
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    roots = edges.select(F.col("dst").alias("node"), F.col("dst").alias("component")).distinct()
    return saved(edges.select(F.col("src").alias("node"), F.col("dst").alias("component")).union(roots), "components")
