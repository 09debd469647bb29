"""Connected components by minimum labels and pointer jumping, as joins on Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import drop_table, table


def components(edges: DataFrame) -> DataFrame:
    """(node, label): label is the least node of the component.  ``edges``: (a, b) longs.

    Each round every node takes the least label among itself and its neighbours, then the
    label of that label, so a path of n edges needs about log n rounds.  Labels live in the
    shared scratch folder; a hub's neighbours are combined before the shuffle."""
    both = table(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = table(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
                       .select("node", F.least("node", "m").alias("label")))
    while True:
        near = (both.join(labels, F.col("b") == F.col("node")).groupBy("a").agg(F.min("label").alias("m")))
        step = labels.join(near, F.col("node") == F.col("a")).select(
            "node", F.col("label").alias("old"), F.least("label", "m").alias("label"))
        step = table(step)
        jump = step.select(F.col("node").alias("j"), F.col("label").alias("to"))
        new = table(step.join(jump, F.col("label") == F.col("j"))
                        .select("node", "old", F.least("label", "to").alias("label")))
        drop_table(labels)
        drop_table(step)
        changed = not new.where(F.col("old") != F.col("label")).isEmpty()
        labels = new.select("node", "label")
        if not changed:
            drop_table(both)
            return labels
