"""Connected components by minimum labels with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm.shared import written
from ledgerflow.operators.spread import frequent, spread_join


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node and label (the smallest node of its component) of every node that has an edge.

    Each round takes the least label among a node's neighbours and then the label's own label,
    so chains shrink by halves. Rounds are written to the shared folder. Neighbours of nodes with
    very many edges, and members of very large components, are dealt over several tasks.
    """
    pairs = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v")
    both = written(pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct())
    labels = written(both.groupBy(F.col("u").alias("v")).agg(F.least(F.col("u"), F.min("v")).alias("label")))
    hubs = frequent(both, "v")
    while True:
        near = spread_join(both, labels, ["v"], [F.col("u")], hot=hubs).groupBy("u").agg(F.min("label").alias("near"))
        step = labels.join(near, labels["v"] == near["u"]).select("v", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        step = written(step)
        jump = labels.select(F.col("v").alias("label"), F.col("label").alias("beyond"))
        step = spread_join(step, jump, ["label"], [F.col("v")], hot=frequent(step, "label"))
        step = written(step.select("v", "old", F.least("label", "beyond").alias("label")))
        labels = step.select("v", "label")
        if step.where("label <> old").isEmpty():
            return labels.select(F.col("v").alias("node"), "label")
