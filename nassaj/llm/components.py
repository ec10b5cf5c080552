"""Connected components of a table of links, by smallest labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nassaj.llm.staging import release, stage


def components(links: DataFrame, x: str, y: str) -> DataFrame:
    """``node, label`` of every node with a link; the label is the smallest node of its component.

    Each round a node takes the smallest label of its neighbours and then its label's own label, so
    the rounds grow with the logarithm of the longest chain. A node with many links is reduced to one
    minimum per task before anything is shuffled. Labels are written each round; no lineage grows.
    """
    a, b = links.select(F.col(x).alias("node"), F.col(y).alias("other")), links.select(
        F.col(y).alias("node"), F.col(x).alias("other")
    )
    edges = stage(a.unionByName(b), "components-edges")
    labels = stage(edges.groupBy("node").agg(F.least("node", F.min("other")).alias("label")), "components-labels")
    while True:
        own = labels.select("node", "label", F.col("label").alias("old"))
        heard = edges.join(labels.withColumnRenamed("node", "other"), "other").groupBy("node").agg(F.min("label").alias("heard"))
        nearer = own.join(heard, "node").select("node", F.least("label", "heard").alias("label"), "old")
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("next"))
        moved = nearer.join(jump, "label", "left").select("node", F.coalesce("next", "label").alias("label"), "old")
        after = stage(moved, "components-labels")
        changed = after.where("label != old").limit(1).count()
        release(labels)
        labels = after.select("node", "label")
        labels.staged_path = after.staged_path
        if not changed:
            release(edges)
            return labels
