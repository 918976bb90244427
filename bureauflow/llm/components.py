"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bureauflow.llm import storage


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) of every node of a link: the least node that it reaches.

    Each round takes the least label of a node's neighbours and then the label of its label, so chains shorten by halves.
    """
    edges = links.select(F.col(a).alias("node"), F.col(b).alias("near")).where("node is not null and near is not null")
    edges = storage.written(edges.union(edges.select("near", "node")).distinct())
    labels = storage.written(edges.groupBy("node").agg(F.least("node", F.min("near")).alias("component")))
    while True:
        near = edges.join(labels.select(F.col("node").alias("near"), "component"), "near").groupBy("node").agg(F.min("component").alias("least"))
        lower = labels.join(near, "node").select("node", F.col("component").alias("old"), F.least("component", "least").alias("component"))
        jump = labels.select(F.col("node").alias("component"), F.col("component").alias("next"))
        new = storage.written(lower.join(jump, "component", "left").select("node", "old", F.least("component", F.coalesce("next", "component")).alias("component")))
        labels = new.select("node", "component")
        if new.where("old <> component").isEmpty():
            return labels
