"""Connected components of an edge table, by minimum labels with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cashbook.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """(node, label): label is the smallest node of the component; ``edges`` has longs a, b.

    Each round sends every node's label along its edges (partial minima
    before the exchange), then lets labels follow their own label.  A star
    needs two rounds, a path of length n about log n.  Every round ends in
    stored tables, so a lost executor repeats one round at most.
    """
    both = stored(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
                  .filter("a <> b").distinct(), "cc-edges")
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low"))
                    .select("node", F.least("node", "low").alias("label")), "cc-labels")
    while True:
        sent = (both.join(labels.select(F.col("node").alias("b"), "label"), "b")
                .groupBy(F.col("a").alias("node")).agg(F.min("label").alias("low")))
        least = labels.join(sent, "node").select("node", F.col("label").alias("old"),
                                                 F.least("label", "low").alias("label"))
        least = stored(least, "cc-sent")
        jump = least.select(F.col("node").alias("label"), F.col("label").alias("far"))
        nxt = stored(least.join(jump, "label").select("node", "old", F.least("label", "far").alias("label")),
                     "cc-labels")
        labels = nxt.select("node", "label")
        if nxt.filter("label <> old").isEmpty():
            return labels
