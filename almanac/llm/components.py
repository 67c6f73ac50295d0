"""Connected components of a large graph, by joins only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from almanac.llm.common import store


def connected(edges: DataFrame) -> DataFrame:
    """``node, component`` (the smallest node it can reach) of every node of
    ``edges`` (a, b: long).  Each round every node takes the smallest label
    among its neighbours' and its own, then its label's label (from the second
    round on); labels only fall, so the rounds end, after about the logarithm of the longest path.
    Each round is a stored table.  Minima are taken before the shuffle, so a node with a great
    many edges is no heavier than others."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct()
    both = store(both, "edges")
    labels = store(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("node")).alias("component")), "labels")
    first = True
    while True:
        seen = (both.join(labels, both.b == labels.node).select(F.col("a").alias("node"), "component")
                .unionByName(labels.withColumn("old", F.col("component")), allowMissingColumns=True)
                .groupBy("node").agg(F.min("component").alias("component"), F.max("old").alias("old")))
        if not first:                  # stars, the usual case, need no label's label
            up = labels.select(F.col("node").alias("component"), F.col("component").alias("next"))
            seen = seen.join(up, "component").select("node", F.least("component", "next").alias("component"), "old")
        step, first = store(seen, "labels"), False
        labels = step.select("node", "component")
        if step.where("old <> component").isEmpty():
            return labels
