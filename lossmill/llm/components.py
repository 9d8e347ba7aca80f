"""Connected components of links, by joins that double their reach."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage


def connected(edges: DataFrame) -> DataFrame:
    """Rows node, component of all nodes in edges (a, b): component is the smallest node reachable.

    Every round takes the smallest label next to a node and then the label of that
    label, and ends with a written table. Only a yes or no comes to the driver.
    """
    edges = edges.select("a", "b").where("a <> b")
    both = cut_lineage(edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = cut_lineage(
        both.groupBy("a").agg(F.min("b").alias("low")).select(F.col("a").alias("node"), F.least("a", "low").alias("label"))
    )
    while True:
        near = (
            both.join(labels.select(F.col("node").alias("b"), "label"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("label").alias("near"))
        )
        lower = labels.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        lower = cut_lineage(lower)
        roots = lower.select(F.col("node").alias("label"), F.col("label").alias("root"))
        labels = cut_lineage(lower.join(roots, "label").select("node", "old", F.col("root").alias("label")))
        moved = not labels.where("label <> old").isEmpty()
        labels = labels.select("node", "label")
        if not moved:
            return labels.select("node", F.col("label").alias("component"))
