"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import save


def _stars(e: DataFrame) -> bool:
    """Whether every node has one smaller neighbour, which has none: the components are found."""
    rows, nodes = e.agg(F.count("*"), F.count_distinct("u")).first()
    return rows == nodes and e.join(e.select(F.col("u").alias("v")), "v", "left_semi").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b longs); the component is its smallest node.

    Each step is an aggregation (partial minima first) and an equi-join; the edges of a step are written to the
    shared folder, so a lost executor costs one step."""
    e = save(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "cc")
    while not _stars(e):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
                 .unionByName(low.select("u", F.col("m").alias("v"))).distinct())
        e = save(small, "cc")
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
