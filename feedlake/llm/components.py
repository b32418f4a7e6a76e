"""Connected components of a graph of numbered nodes, in rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlake.plans.shared import discard, settle


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``label`` (the least node reachable) for every end of ``edges`` (a, b).

    The result is a settled table, to be discarded by the caller.

    Each round takes the least label of all neighbours and then that label's own label, which
    halves long paths. Every round is settled, so a lost executor costs no more than one round.
    Labels of a hub reach its neighbours through a join that splits skewed keys, and are reduced
    before they are shuffled.
    """
    both = settle(
        edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        .distinct(),
        "component_edges",
    )
    labels = settle(
        both.groupBy(F.col("a").alias("node")).agg(F.least(F.first("a"), F.min("b")).alias("label")),
        "component_labels",
    )
    while True:
        heard = (
            both.join(labels.select(F.col("node").alias("a"), "label"), "a")
            .groupBy(F.col("b").alias("node"))
            .agg(F.min("label").alias("heard"))
        )
        better = labels.select("node", "label").join(heard, "node").select(
            "node", F.col("label").alias("old"), F.least("label", "heard").alias("label")
        )
        jumped = better.join(
            labels.select(F.col("node").alias("label"), F.col("label").alias("further")), "label"
        ).select("node", "old", F.least("label", "further").alias("label"))
        before, labels = labels, settle(jumped, "component_labels")
        discard(before)
        if labels.where("old <> label").isEmpty():
            discard(both)
            return labels
