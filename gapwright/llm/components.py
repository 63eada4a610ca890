"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gapwright.llm.common import cut


def components(links: DataFrame) -> DataFrame:
    """(node, root): for every node of links (a, b), the smallest node reachable.

    Each round a node takes the smallest label around it, then that label's own label, so that paths
    halve; a round's labels are cut from their lineage. An empty table of links gives an empty result.
    """
    pairs = links.select("a", "b").where("a is not null and b is not null and a <> b")
    edges = cut(pairs.union(pairs.select("b", "a")).distinct())
    labels = cut(edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select("node", F.least("node", "m").alias("root")))
    while True:
        around = (
            edges.join(labels.withColumnRenamed("node", "b"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("root").alias("near"))
            .join(labels, "node")
            .select("node", "root", F.least("near", "root").alias("low"))
        )
        jump = labels.select(F.col("node").alias("low"), F.col("root").alias("lower"))
        after = cut(around.join(jump, "low", "left").select("node", F.coalesce(F.least("low", "lower"), "low").alias("new"), "root"))
        done = after.where("new <> root").isEmpty()
        labels = after.select("node", F.col("new").alias("root"))
        if done:
            return labels
