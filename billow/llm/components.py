"""Connected components of a link table, kept as tables throughout."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from billow.llm.common import discard, stored


def connected_components(links: DataFrame) -> DataFrame:
    """links (a, b), in any order, repeats allowed -> (node, label): the smallest node each one reaches.

    Every round a node takes the smallest label among its own and its neighbours' ones, then the label of
    that label (pointer jumping), so that chains of links shorten fast; the rounds end when no label
    changes.  Labels are aggregated before they are shuffled, so a node with very many links is no hot key."""
    both = stored(links.select("a", "b").union(links.select("b", "a")).where("a <> b").distinct(), "cc_links")
    table = labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
                    .select("node", F.least("node", "m").alias("label")), "cc_labels")
    while True:
        near = (both.join(labels.select(F.col("node").alias("b"), "label"), "b")
                .groupBy(F.col("a").alias("node")).agg(F.min("label").alias("seen")))
        step = labels.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "seen").alias("label"))
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("next"))
        after = stored(step.join(jump, "label", "left").select(
            "node", "old", F.least("label", F.coalesce("next", "label")).alias("label")), "cc_labels")
        discard(table)
        table, labels = after, after.drop("old")
        if after.where("old <> label").isEmpty():
            discard(both)
            return labels
