"""Connected components of an edge table by alternating star contraction.

Large-star links each node's larger neighbours to its least neighbour, small-star
its smaller ones; the edges become stars around the least node of each component
after a few rounds. Each round is a min by key and an equi-join, written to the
shared folder, so no step follows the length of a path and nothing is collected.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_stage, stage


def _star(edges: DataFrame, large: bool) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else edges
    least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    linked = both.join(least, "u")
    if large:
        moved = linked.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        moved = (linked.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(least.select("u", F.col("m").alias("v"))))
    return moved.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of ``edges`` (x, y) but the least of each
    component, which names it."""
    spark = edges.sparkSession
    found, path = stage(edges.filter("x <> y").select(F.greatest("x", "y").alias("u"), F.least("x", "y").alias("v"))
                        .distinct())
    mark = None
    while True:
        moved, next_path = stage(_star(_star(found, True), False))
        now = moved.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s"),
                        F.countDistinct("u").alias("d")).first()
        drop_stage(spark, path)
        found, path = moved, next_path
        if tuple(now) == mark or now["n"] == 0:
            return found.select(F.col("u").alias("node"), F.col("v").alias("component"))
        mark = tuple(now)
