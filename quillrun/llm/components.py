"""Connected components of a table of links, by label propagation with shortcuts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillrun.llm.storage import stored


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """``(node, label)`` of every linked node; the label is the least node it reaches.

    In each round a node takes the least label among its neighbours and itself, and then
    the label of that label, so that rounds grow with the logarithm of the longest path.
    Links with a null end, and loops, count for nothing; no links give no rows.
    """
    one_way = links.select(F.col(a).alias("node"), F.col(b).alias("other")).filter("node <> other")
    edges = stored(
        one_way.union(
            one_way.select(F.col("other").alias("node"), F.col("node").alias("other"))
        ).distinct()
    )
    labels = stored(
        edges.groupBy("node")
        .agg(F.min("other").alias("label"))
        .withColumn("label", F.least("node", "label"))
    )
    while True:
        near = (
            edges.join(labels.select(F.col("node").alias("other"), "label"), "other")
            .groupBy("node")
            .agg(F.min("label").alias("near"))
        )
        step = labels.join(near, "node").select(
            "node", F.col("label").alias("old"), F.least("label", "near").alias("via")
        )
        roots = labels.select(F.col("node").alias("via"), F.col("label").alias("root"))
        moved = stored(
            step.join(roots, "via").select("node", "old", F.least("via", "root").alias("label"))
        )
        labels = moved.select("node", "label")
        if moved.filter("label <> old").isEmpty():
            return labels
