"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import materialise


def _is_forest_of_stars(cur: DataFrame) -> bool:
    """Every node has one parent and no parent has one."""
    twice = cur.groupBy("u").agg(F.count("*").alias("n")).where("n > 1").select("u")
    deep = cur.select("u").join(cur.select(F.col("v").alias("u")), "u", "left_semi")
    return not twice.unionAll(deep).take(1)


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, component`` for every node of ``edges``; a component is named by its smallest node.

    Edges may repeat, run either way or join a node to itself; null ends are ignored.
    Nodes without an edge to another are not returned. Rounds (logarithmic in the longest
    chain) are cut by tables in the shared folder; nothing is gathered on the driver. The
    minimum of a node's neighbours is combined before the shuffle, so a node with a third
    of all edges costs no more than its rows.
    """
    spark = edges.sparkSession
    both = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a <> b")
    cur = materialise(spark, both.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    while not _is_forest_of_stars(cur):
        near = cur.unionAll(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # Tables of their own, so that Spark may split the side of a node with many edges.
        low = near.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = near.join(materialise(spark, low, "low"), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = materialise(spark, large, "large-star")
        low = materialise(spark, large.groupBy("u").agg(F.min("v").alias("m")), "low")
        small = large.join(low, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        cur = materialise(spark, small.unionAll(low.select("u", F.col("m").alias("v"))).distinct(), "small-star")
    return cur.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(
        cur.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
