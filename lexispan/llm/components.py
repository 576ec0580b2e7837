"""Connected components of a graph of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexispan.llm.shared import forget, stored


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, component)`` for every node of ``links``, the component named by its smallest node.

    Each round takes the smallest label among a node and its neighbours and then the
    label of that label, so that long chains halve; it ends when no label changes.
    Labels stay distributed and are stored after each round.
    """
    both = links.select(F.col(a).alias("node"), F.col(b).alias("other"))
    both = stored(
        both.unionByName(both.select(F.col("other").alias("node"), F.col("node").alias("other")))
        .filter("node IS NOT NULL AND other IS NOT NULL").distinct(),
        "links",
    )
    labels = stored(
        both.groupBy("node").agg(F.least(F.col("node"), F.min("other")).alias("component")), "labels")
    while True:
        around = both.join(labels.withColumnRenamed("node", "other"), "other").groupBy("node").agg(
            F.min("component").alias("near"))
        stepped = labels.join(around, "node").select(
            "node", F.col("component").alias("before"), F.least("component", "near").alias("now"))
        onward = labels.select(F.col("node").alias("now"), F.col("component").alias("next"))
        after = stored(
            stepped.join(onward, "now").select(
                "node", F.least("now", "next").alias("component"),
                (F.least("now", "next") < F.col("before")).alias("changed")),
            "labels",
        )
        forget(labels)
        labels = after
        if labels.filter("changed").isEmpty():
            forget(both)
            return labels.select("node", "component")
