"""Connected components by contraction, as joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for the nodes of edges (a, b); label: the smallest node reachable.

    In each round every node points to its smallest neighbour or itself, pointers are shortened, and edges are redrawn
    between the nodes pointed to. Hubs of any degree are met by joins and partial minima only.
    """
    label = None
    edges = staged(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "cc-edges")
    while not edges.isEmpty():
        both = edges.select("a", "b").union(edges.select("b", "a"))
        to = both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"), F.least("a", "b").alias("to"))
        to = staged(to, "cc-pointers")  # read from a table, both sides of the joins below can be split at a hub
        for _ in range(2):
            nxt = to.select(F.col("node").alias("to"), F.col("to").alias("nxt"))
            to = to.join(nxt, "to", "left").select("node", F.coalesce("nxt", "to").alias("to"))
        to = staged(to, "cc-pointers")
        if label is None:
            label = to.withColumnRenamed("to", "label")
        else:
            step = to.withColumnRenamed("node", "label")
            label = staged(label.join(step, "label", "left").select("node", F.coalesce("to", "label").alias("label")), "cc-labels")
        a = edges.join(to.select(F.col("node").alias("a"), F.col("to").alias("x")), "a").select("x", "b")
        moved = a.join(to.select(F.col("node").alias("b"), F.col("to").alias("y")), "b")
        edges = staged(moved.where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "cc-edges")
    if label is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("label"))
    return label
