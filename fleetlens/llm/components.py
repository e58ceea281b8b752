"""Connected components of an edge table, by labels that only shrink."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens.llm.shared import stored


def components(edges: DataFrame) -> DataFrame:
    """``node, label`` for every node of ``a - b``; label: the component's smallest node.

    Each round takes the smallest label around a node and then that label's own
    label, so a chain of n links needs about log n rounds. Rounds are written to
    the shared folder: a lost executor costs a re-read, not the rounds before.
    Nodes with very many links meet in sums that Spark takes before shuffling.
    Null ends and self-links are ignored; repeated links count once.
    """
    links = edges.select("a", "b").where("a <> b").distinct()
    links = stored(links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    labels = stored(links.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("label")), "labels")
    while True:
        old = labels
        around = (links.join(old.select(F.col("node").alias("b"), "label"), "b")
                  .groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near")))
        hooked = old.join(around, "node").select(
            "node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        roots = old.select(F.col("node").alias("label"), F.col("label").alias("root"))
        jumped = hooked.join(roots, "label").select("node", "old", F.col("root").alias("label"))
        done = stored(jumped, "labels")
        labels = done.select("node", "label")
        if done.where("old <> label").isEmpty():
            return labels
