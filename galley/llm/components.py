"""Connected components of an edge table, by passing smallest labels along edges and jumping pointers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from galley.session import materialize


def components(edges: DataFrame) -> DataFrame:
    """``(node, label)`` for every node of an edge ``(a, b)``; the label is the component's smallest node.

    Each round takes the smallest label among the neighbours, then the label's own label, and writes the
    table, so that no lineage grows and lost executors cost one round. Sums per node are merged before
    the shuffle, so a hub does not gather its neighbours in one task.
    """
    both = materialize(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "edges")
    labels = materialize(both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"), F.least("a", "b").alias("label")), "labels")
    while True:
        sent = both.join(labels, both.a == labels.node).groupBy(F.col("b").alias("target")).agg(F.min("label").alias("offer"))
        nearer = labels.join(sent, labels.node == sent.target, "left").select(
            "node", F.col("label").alias("old"), F.least("label", F.coalesce("offer", "label")).alias("label")
        )
        nearer = materialize(nearer, "labels")
        jump = nearer.select(F.col("node").alias("place"), F.col("label").alias("beyond"))
        labels = nearer.join(jump, nearer.label == jump.place, "left").select("node", "old", F.least("label", F.coalesce("beyond", "label")).alias("label"))
        labels = materialize(labels, "labels")
        if labels.where("old <> label").isEmpty():
            return labels.select("node", "label")
        labels = labels.select("node", "label")
