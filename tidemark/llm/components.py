"""Connected components of links in a table, by rounds of joins; nothing comes to the driver but counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.runtime import store


def components(links: DataFrame) -> DataFrame:
    """(node, label) for all nodes of links (a, b: long): the smallest node that each can reach.

    A round takes the least label among a node and its neighbours, then that
    label's own label. A node with very many links is pre-aggregated before its
    shuffle, and joins on it can be split, as Spark deals them out itself. Nodes
    are not null; links of a node with itself, and repeated ones, change nothing,
    and without links there are no nodes.
    """
    links = links.filter("a <> b")
    both = store(links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    labels = store(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("label")), "labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        hooked = labels.join(near, "node").select("node", "label", F.least("label", "near").alias("new"))
        jump = labels.select(F.col("node").alias("new"), F.col("label").alias("further"))
        moved = store(hooked.join(jump, "new").select("node", F.least("new", "further").alias("label"), (F.least("new", "further") != F.col("label")).alias("moved")), "labels")
        labels = moved.select("node", "label")
        if not moved.filter("moved").limit(1).count():
            return labels
