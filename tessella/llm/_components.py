"""Connected components of a link table, without bringing links to the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._spark import cut_lineage


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) of all nodes of a link table: the smallest node reachable.

    Each round takes the least label among the neighbours and then follows labels of labels, so a chain
    of n links needs about log n rounds. Minima are combined before the shuffle, so a node of very
    many links is no hot group; the joins can be split where they are skewed.
    """
    edges = links.select(F.col(a).alias("x"), F.col(b).alias("y")).filter("x <> y")
    edges = cut_lineage(edges.unionAll(edges.select(F.col("y").alias("x"), F.col("x").alias("y"))).distinct())
    labels = edges.groupBy(F.col("x").alias("node")).agg(F.least(F.first("x"), F.min("y")).alias("component"))
    while True:
        labels = cut_lineage(labels)
        near = edges.join(labels.select(F.col("node").alias("y"), "component"), "y").groupBy("x").agg(F.min("component").alias("near"))
        nearer = labels.join(near.withColumnRenamed("x", "node"), "node").select("node", "component", F.least("component", "near").alias("l"))
        jump = labels.select(F.col("node").alias("l"), F.col("component").alias("further"))
        new = cut_lineage(nearer.join(jump, "l", "left").select("node", F.col("component").alias("old"), F.least("l", F.coalesce("further", "l")).alias("component")))
        if new.filter("old <> component").isEmpty():
            return new.select("node", "component")
        labels = new.select("node", "component")
