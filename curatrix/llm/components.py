"""Connected components of a stored edge list by alternating large-star and small-star steps.

Edges stay in tables of the shared folder; only one count a round reaches the driver. A
round maps every neighbour of a node to the least node it knows, first among larger
neighbours, then among smaller ones, and ends when no edge changes (Kiveris et al. 2014).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curatrix.llm.common import materialize


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """edges (a, b) -> edges to the least neighbour; the minimum is pre-aggregated and joined
    back, so a node with many neighbours is a skewed join side, not one group."""
    if large:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("least")).select("a", F.least("a", "least").alias("least"))
        return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b")).where("a <> b").distinct()
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("least"))
    linked = down.join(least, "a")
    return linked.select(F.col("b").alias("a"), F.col("least").alias("b")).unionByName(least.select("a", F.col("least").alias("b"))).where("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the least node reachable, for every node of an edge but the least."""
    current = materialize(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "edges")
    while True:
        # A star forest, each node pointing at a node that points nowhere, can't change.
        open_nodes = current.groupBy("a").agg(F.count("*").alias("n")).where("n > 1").select("a").unionByName(current.select("b").join(current.select(F.col("a").alias("b")), "b", "left_semi").select(F.col("b").alias("a")))
        if open_nodes.isEmpty():
            return current.select(F.col("a").alias("node"), F.col("b").alias("component"))
        current = materialize(_star(_star(current, True), False), "edges")
