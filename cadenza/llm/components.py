"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.llm.common import stored


def _both(edges: DataFrame) -> DataFrame:
    return edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _to_least(neighbours: DataFrame) -> DataFrame:
    """Per node: its neighbours ``b`` and the least id of node and neighbours."""
    least = neighbours.groupBy("a").agg(F.min("b").alias("m"))
    return neighbours.join(least, "a").withColumn("m", F.least("a", "m"))


def _star(edges: DataFrame) -> DataFrame:
    large = _to_least(_both(edges)).where("b > a").select(F.col("b").alias("a"), "m")
    large = large.where("a > m").select("a", F.col("m").alias("b")).distinct()
    down = _to_least(large)
    small = down.select(F.col("b").alias("a"), "m").union(down.select("a", "m"))
    return small.where("a > m").select("a", F.col("m").alias("b")).distinct()


def components(edges: DataFrame, label: str) -> DataFrame:
    """``(node, component)`` for every node of ``edges`` (``a > b``, long ids); the
    component is its least node.

    The steps shrink any component to a star around its least node in a logarithmic number
    of rounds. A busy node's least neighbour is found by partial minima, and its join with
    them is one that adaptive execution can split. Each round is stored, so that a lost
    executor does not repeat earlier ones.
    """
    mark, seen = None, edges
    while True:
        total = seen.agg(
            F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
        if total == mark or not total[0]:
            break
        mark, seen = total, stored(_star(seen), label)
    nodes = seen.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = seen.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return nodes.union(roots)
