"""Connected components of an edge table, by alternating large and small stars.

A round replaces the neighbours of each node by links to the least node among
them, by aggregates and joins only, so a node with a third of all edges is
summed before its shuffle and split in its joins. The edges of every round are
written to the shared folder. The number of rounds grows with the logarithm of
the largest component.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salespipe.llm.store import written


def _toward_least(spark: SparkSession, edges: DataFrame, label: str) -> DataFrame:
    """Each edge (u, v) with the least of u and all v of that u as ``m``."""
    least = edges.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return edges.join(written(spark, least, label), "u")


def _state(edges: DataFrame) -> tuple:
    hashed = F.xxhash64("u", "v").cast("decimal(38,0)")
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(hashed)).first())


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """Of edges (u, v): every node that has an edge to another, and the least node it reaches, as (node, component).

    Edges may repeat and point either way; loops and NULL ends are left out.
    """
    pairs = edges.where("u is not null and v is not null and u <> v")
    pairs = pairs.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    now = written(spark, pairs, "edges")
    state = _state(now)
    while state[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _toward_least(spark, both, "least").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = written(spark, large.distinct(), "large-star")
        small = _toward_least(spark, large, "least")
        small = small.select(
            F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e")
        ).select("e.u", "e.v").where("u <> v")
        now = written(spark, small.distinct(), "small-star")
        last, state = state, _state(now)
        if state == last:
            break
    roots = now.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("component"))
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
