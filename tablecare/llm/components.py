"""Connected components of a graph of links, by hooking and pointer jumping on staged tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablecare.llm.common import stage


def components(edges: DataFrame) -> DataFrame:
    """(node, comp) for every end of the edges (a, b): comp is the smallest node reachable.

    Each round takes the smallest label among the neighbours, then the label of
    that label; rounds grow with the logarithm of the longest path.
    """
    both = stage(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "edges")
    labels = stage(both.groupBy(F.col("a").alias("node")).agg(
        F.least(F.first("a"), F.min("b")).alias("comp")), "labels")
    while True:
        seen = (both.join(labels, both["b"] == labels["node"])
                .groupBy("a").agg(F.min("comp").alias("near")))
        hooked = labels.join(seen, labels["node"] == seen["a"]).select(
            "node", F.col("comp").alias("old"), F.least("comp", "near").alias("hook"))
        jump = labels.select(F.col("node").alias("hook"), F.col("comp").alias("far"))
        new = stage(hooked.join(jump, "hook").select(
            "node", F.least("hook", "far").alias("comp"), "old"), "labels")
        changed = new.filter("comp <> old").limit(1).count()
        labels = new.drop("old")
        if not changed:
            return labels
