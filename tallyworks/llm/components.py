"""Connected components of a link table, by alternating large-star and small-star steps.

Each step is an aggregate and a join, so no component is ever gathered in one place; the label of a component is its
smallest node. The number of rounds grows with the logarithm of the longest chain.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyworks.session import cut_lineage


def _lowest(edges: DataFrame) -> DataFrame:
    """The edges (u, v) with the smallest node next to u, u included."""
    low = edges.groupBy("u").agg(F.min("v").alias("low")).select("u", F.least("u", "low").alias("low"))
    return edges.join(low, "u")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _lowest(both).where("v > u").select(F.col("v").alias("u"), F.col("low").alias("v")).where("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    met = _lowest(down)
    return met.select(F.explode(F.array("u", "v")).alias("u"), F.col("low").alias("v")).where("u <> v").distinct()


def components(links: DataFrame) -> DataFrame:
    """node and component (the smallest node it is connected with) for every node of the links (a, b).

    Links with a null end or between a node and itself say nothing; nodes without another link do not appear.
    """
    edges = links.where("a <> b").select(F.col("a").alias("u"), F.col("b").alias("v"))
    edges = cut_lineage(edges.distinct())
    seen = None
    while True:
        edges = cut_lineage(_small_star(_large_star(edges)))
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
    roots = edges.select(F.col("v").alias("node")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots.withColumn("component", F.col("node")))
