"""Connected components of an undirected edge list, by minimum labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import saved


def components(edges: DataFrame) -> DataFrame:
    """(node, label) of every node in ``edges`` (a, b); the label is the least node reached.

    Every round each node takes the least label among its neighbours, then
    the label of its label (pointer jumping), so long chains close in a
    logarithmic number of rounds.  Labels are grouped sums of one value per
    edge; a node with many edges is pre-aggregated on the map side.  Every
    round is written to the shared checkpoint folder.
    """
    both = saved(edges.select("a", "b").union(edges.select(F.col("b"), F.col("a")))
                 .where("a <> b").distinct(), "edges")
    labels = saved(both.groupBy(F.col("a").alias("node"))
                   .agg(F.min("b").alias("least"))
                   .select("node", F.least("node", "least").alias("label")), "labels")
    while True:
        near = (both.join(labels, both["b"] == labels["node"]).groupBy(both["a"].alias("node"))
                .agg(F.min("label").alias("near")))
        lower = saved(labels.join(near, "node").select(
            "node", F.col("label").alias("old"), F.least("label", "near").alias("label")), "lower")
        target = lower.select(F.col("node").alias("__t"), F.col("label").alias("__l"))
        jumped = saved(lower.join(target, F.col("label") == F.col("__t")).select(
            "node", "old", F.least("label", "__l").alias("label")), "labels")
        labels = jumped.select("node", "label")
        if jumped.where("label <> old").isEmpty():
            return labels
