"""Connected components of a table of links, by label spreading with shortcuts.

Each round a node takes the smallest label among its own, its neighbours' and its
label's label. A round is stored in the shared folder, so lineage stays short and a
lost executor costs no more than one round. A node with very many links only sends
its label through the partial minimum.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.sources.workspace import new_run_root, stored


def components(spark: SparkSession, links: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable from each node of ``links`` (a, b)."""
    root = new_run_root(spark, "components")
    both = stored(
        spark, links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), root, "links"
    )
    labels = stored(
        spark, both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("label")), root, "labels-0"
    )
    turn = 0
    while True:
        turn += 1
        heard = (
            both.join(labels, both["a"] == labels["node"])
            .groupBy(F.col("b").alias("node"))
            .agg(F.min("label").alias("heard"))
        )
        onward = labels.select(F.col("node").alias("label"), F.col("label").alias("jump"))
        after = stored(
            spark,
            labels.join(heard, "node")
            .join(onward, "label", "left")
            .select("node", F.least("label", "heard", F.coalesce("jump", "label")).alias("label"), F.col("label").alias("was")),
            root,
            f"labels-{turn}",
        )
        if after.where("label <> was").isEmpty():
            return after.select("node", F.col("label").alias("component"))
        labels = after.select("node", "label")
