"""Connected components by alternating stars: every step is a grouped minimum and a join on the node."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wicklake.llm.common import staged


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of `edges` (a, b); the component is its smallest node.

    Alternates two steps until no edge changes. The large step ties each larger neighbour of a node to the
    smallest node around it, the small step does so for the smaller neighbours. Edges shrink to one per node;
    a round is a few shuffles, and the number of rounds grows with the logarithm of the longest path. The
    edges are staged after each round, and only their count and checksum reach the driver. A node with very
    many edges costs one row per task in the grouped minimum; the joins leave room for Spark's skew handling.
    Rows with a null end and loops are left out. No edges give no rows.
    """
    current = staged(
        edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .filter("a IS NOT NULL AND b IS NOT NULL AND a <> b").distinct(), "edges")
    seen = None
    while True:
        state = current.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if state["n"] == 0 or state == seen:
            break
        seen = state
        current = staged(_small_star(_large_star(current)), "edges")
    return (current.select(F.col("u").alias("node"), F.col("v").alias("component"))
            .union(current.select("v", "v")).groupBy("node").agg(F.min("component").alias("component")))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return (edges.select(F.col("v").alias("u"), F.col("u").alias("v")).join(least, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    ordered = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = ordered.groupBy("u").agg(F.min("v").alias("m"))
    lower = ordered.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
    return lower.union(least.select("u", F.col("m").alias("v"))).distinct()
