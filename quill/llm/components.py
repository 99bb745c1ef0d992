"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quill.llm.io import written


def components(edges: DataFrame) -> DataFrame:
    """``(node, label)`` for every node of ``edges`` (columns ``a``, ``b``): equal
    labels exactly within a component.

    Every round contracts each node into the least node next to it and keeps the
    edges between different results. With nodes in random order (hashes) the edge
    list shrinks by a constant factor a round. Edges and labels stay distributed and
    are written to shared storage each round."""
    labels = None
    edges = edges.select("a", "b")
    while True:
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parent = written(both.groupBy("a").agg(F.min("b").alias("b")).select(
            F.col("a").alias("node"), F.least("a", "b").alias("label")))
        labels = parent if labels is None else written(relabel(labels, parent))
        up_a = parent.select(F.col("node").alias("a"), F.col("label").alias("x"))
        up_b = parent.select(F.col("node").alias("b"), F.col("label").alias("y"))
        edges = written(edges.join(up_a, "a").join(up_b, "b").where("x != y").select(
            F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct())
        if edges.isEmpty():
            return labels


def relabel(labels: DataFrame, parent: DataFrame) -> DataFrame:
    """``labels`` carried on by ``parent``, labels without a parent as they are."""
    up = parent.select(F.col("node").alias("label"), F.col("label").alias("_up"))
    return labels.join(up, "label", "left").select("node", F.coalesce("_up", "label").alias("label"))
