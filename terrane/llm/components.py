"""Connected components of a graph given by its edges, by contraction in rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrane.llm.common import staged


def connected(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of the edges (a, b); a component is named by a node.

    Each round maps every node to its smallest neighbour, if smaller, and contracts the edges
    by that map; composed maps lead to the components. Node ids are hashes, so that a round
    leaves a fixed share of the nodes at most, in expectation. Every round is written to the
    shared folder and starts from there.
    """
    edges = staged(edges.select("a", "b").filter("a <> b").distinct(), "edges")
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    total = staged(both.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct(), "nodes")
    while edges.take(1):
        both = edges.select("a", "b").unionByName(
            edges.select(F.col("b").alias("a"), F.col("a").alias("b"))
        )
        hooks = staged(both.groupBy("a").agg(F.least("a", F.min("b")).alias("hook")), "hooks")
        total = staged(
            total.join(hooks, F.col("component") == F.col("a"), "left").select(
                "node", F.coalesce("hook", "component").alias("component")
            ),
            "nodes",
        )
        left = edges.join(hooks, "a").select("b", F.col("hook").alias("left"))
        moved = left.join(hooks.withColumnRenamed("a", "b"), "b").select("left", F.col("hook").alias("right"))
        contracted = moved.filter("`left` <> `right`").select(
            F.least("left", "right").alias("a"), F.greatest("left", "right").alias("b")
        )
        edges = staged(contracted.distinct(), "edges")
    return total
