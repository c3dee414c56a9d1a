"""Connected components of very large graphs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.staging import staged


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's smallest neighbour."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = staged(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), "components-least")
    return both.join(least.hint("merge"), "a").filter("b > a").select(F.col("m").alias("a"), "b")


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, are linked to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = staged(down.groupBy("a").agg(F.min("b").alias("m")), "components-least")
    rest = down.join(least.hint("merge"), "a").filter("b <> m").select(F.col("m").alias("a"), "b")
    return rest.unionByName(least.select(F.col("m").alias("a"), F.col("a").alias("b")))


def connected(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component) of every node with an edge; a component's name is its smallest node.

    Large-star and small-star steps alternate until no edge changes; each pair
    of steps is written to the shared folder, so lineage stays short. A hub is
    no hot group: minima are combined before their shuffle, and written before
    the join, which then splits large partitions. Nodes are never broadcast: Spark
    would go by the size of their packed files.
    """
    now = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).filter("a <> b")
    before = None
    while True:
        now = staged(_large_star(now).distinct(), "components")
        now = staged(_small_star(now).distinct(), "components")
        # An order-free mark of the edges, exact but for a chance of 2**-64.
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == before:
            return now.select(F.col("b").alias("node"), F.col("a").alias("component")).unionByName(
                now.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct())
        before = mark
