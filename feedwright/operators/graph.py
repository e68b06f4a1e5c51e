"""Connected components of an edge table, by minimum labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedwright.storage import discard, materialize


def contracted(edges: DataFrame) -> DataFrame:
    """(a, b), a > b, of the same components as edges: each node keeps the edge to its least neighbour, and its other
    lesser neighbours are tied to that one.  Nodes that share neighbours share those ties, so a group of
    nodes with many edges each is left with little more than one each."""
    down = materialize(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "down")
    least = materialize(down.groupBy("a").agg(F.min("b").alias("least")), "least")
    ties = down.join(least, "a").where("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    out = materialize(least.select("a", F.col("least").alias("b")).unionByName(ties).distinct(), "contracted")
    discard(down)
    discard(least)
    return out


def components(edges: DataFrame) -> DataFrame:
    """(node, label): the smallest node that each end of an edge is connected to.

    edges: (a, b), nodes of any one type that has an order, in any direction, repeated or not.
    Labels and edges stay distributed; each round is written to the shared folder, and the one
    before is deleted.  The rounds grow with the logarithm of the longest path.  A hub's rows are
    combined before the shuffle.  What waits for the label of a hub, or for the root of a label that
    many nodes have, is joined to a written table, one row a node: adaptive execution splits such a
    join where a hub's rows are many, and no row is repeated for that.
    """
    few = contracted(edges)
    both = materialize(few.unionByName(few.select(F.col("b").alias("a"), F.col("a").alias("b"))), "edges")
    discard(few)
    if both.isEmpty():
        return both.select(F.col("a").alias("node"), F.col("b").alias("label"))
    labels = materialize(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("b")).select("node", F.least("node", "b").alias("label")), "labels")
    while True:
        of_b = labels.select(F.col("node").alias("b"), F.col("label").alias("of_b"))
        near = both.join(of_b, "b").groupBy(F.col("a").alias("node")).agg(F.min("of_b").alias("near"))
        lower = labels.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        lower = materialize(lower, "lower")
        # Every label is a node, so each has a root.
        roots = lower.select(F.col("node").alias("label"), F.col("label").alias("root"))
        after = lower.join(roots, "label").select("node", F.col("root").alias("label"), "old")
        after = materialize(after, "labels")
        discard(lower)
        discard(labels)
        labels = after
        if labels.where("label <> old").isEmpty():
            discard(both)
            return labels.select("node", "label")
