"""Connected components of a link table, by smallest label with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded, dropped, written


def connected_components(links: DataFrame) -> DataFrame:
    """(node, label) for every node of ``links`` (a, b): label is the smallest node it reaches.

    Each round takes the smallest label among neighbours, then the label's own label, so long
    chains halve; the work of a round is proportional to the links.
    """
    both = links.select(F.col("a").alias("u"), F.col("b").alias("v")).where("u <> v")
    both = written(both.union(both.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct(), "links")
    labels = written(
        both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("node"), F.least("u", "m").alias("label")),
        "labels",
    )
    while True:
        known = bounded(labels)
        near = (
            both.join(known, F.col("v") == F.col("node"))
            .groupBy("u")
            .agg(F.min("label").alias("m"))
            .join(known, F.col("u") == F.col("node"))
            .select("node", "label", F.least("label", "m").alias("step"))
        )
        up = bounded(labels.select(F.col("node").alias("at"), F.col("label").alias("jump")))
        new = written(
            near.join(up, F.col("step") == F.col("at"), "left").select(
                "node", F.least("step", "jump").alias("label"), F.col("label").alias("was")
            ),
            "labels",
        )
        done = new.where("label <> was").limit(1).count() == 0
        dropped(labels)
        labels = new.select("node", "label")
        if done:
            dropped(both)
            return labels
