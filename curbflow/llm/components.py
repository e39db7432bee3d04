"""Connected components by contraction: every node moves to its smallest neighbour until no edge is left."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbflow.llm.tables import written


def components(edges: DataFrame, name: str) -> DataFrame:
    """(node, label) of every node in edges (a, b: long): nodes have the same label exactly if edges connect them.

    A round maps each node to the smallest of itself and its neighbours and rewrites the edges; for nodes in no
    special order a constant share of them disappears each time. Minima are aggregated before they are shuffled.
    No edges give no rows; edges of a node to itself, and repeated ones, change nothing."""
    both = edges.filter("a <> b").select("a", "b")
    both = written(both.unionByName(both.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), f"{name}-edges")
    labels = None
    while not both.isEmpty():
        moves = written(
            both.groupBy("a").agg(F.least("a", F.min("b")).alias("to")).withColumnRenamed("a", "node"), f"{name}-moves"
        )
        ends = moves.select(F.col("node").alias("a"), F.col("to").alias("new_a"))
        other = moves.select(F.col("node").alias("b"), F.col("to").alias("new_b"))
        both = written(
            both.join(ends, "a").join(other, "b").filter("new_a <> new_b")
            .select(F.col("new_a").alias("a"), F.col("new_b").alias("b")).distinct(),
            f"{name}-edges",
        )
        if labels is None:
            labels = moves.select("node", F.col("to").alias("label"))
        else:
            later = moves.select(F.col("node").alias("label"), "to")
            labels = written(
                labels.join(later, "label", "left").select("node", F.coalesce("to", "label").alias("label")), f"{name}-labels"
            )
    if labels is None:
        return both.select(F.col("a").alias("node"), F.col("b").alias("label"))
    return labels
