"""Connected components of links between long ids, without collecting any of them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sommelix.llm.common import cut


def components(links: DataFrame) -> DataFrame:
    """node and component (the smallest node reachable) from links a, b. Each round takes the smallest label among a
    node's neighbours and then the label's own label, so labels travel ever farther; rounds end when none changes."""
    both = cut(links.select("a", "b").union(links.select("b", "a")).where("a <> b").distinct())
    labels = cut(both.groupBy("a").agg(F.least("a", F.min("b")).alias("component")).withColumnRenamed("a", "node"))
    while True:
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy("a").agg(F.min("component").alias("near"))
        lower = labels.join(near.withColumnRenamed("a", "node"), "node").select(
            "node", F.col("component").alias("old"), F.least("component", "near").alias("component")
        )
        lower = cut(lower)
        jump = lower.select(F.col("node").alias("component"), F.col("component").alias("next"))
        after = cut(lower.join(jump, "component").select("node", "old", F.least("component", "next").alias("component")))
        labels = after.select("node", "component")
        if after.where("component <> old").isEmpty():
            return labels
