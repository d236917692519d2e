"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from collatio.llm.shared import durable


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node gets an edge to the smallest node around it."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    # Written on its own, so that the join can be split where a node has many neighbours.
    least = durable(both.groupBy("a").agg(F.min("b").alias("m")))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.least("a", "m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours get edges to the smallest of those."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b")))


def components(edges: DataFrame) -> DataFrame:
    """(node, comp) for every node of edges (a, b): comp is the smallest node that can be reached.

    No step gathers a node's neighbours; a node with many costs a minimum and a join. Ends when a round of both steps
    changes nothing, after about log(nodes) rounds.
    """
    now = durable(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct())
    mark = None
    while True:
        after = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if after == mark or after[0] == 0:
            break
        mark = after
        now = durable(_small_star(_large_star(now).distinct()).distinct())
    return now.select(F.col("a").alias("node"), F.col("b").alias("comp")).unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("comp")).distinct())
