"""Connected components of an edge list by least labels and pointer jumping, as Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartorio.llm.frames import reliable


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (a, b): root is the least node of its component.

    Every round takes the least label among the neighbours and then that label's own label, so chains shrink
    geometrically. Each round is checkpointed; only one number, the count of changes, reaches the driver.
    """
    links = reliable(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).filter("a <> b").distinct())
    labels = reliable(links.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least")).select("node", F.least("node", "least").alias("root")))
    while True:
        near = (links.join(labels, links["b"] == labels["node"]).groupBy("a").agg(F.min("root").alias("near")))
        new = labels.join(near, labels["node"] == near["a"]).select("node", F.col("root").alias("old"), F.least("root", "near").alias("root"))
        up = labels.select(F.col("node").alias("root"), F.col("root").alias("above"))
        new = reliable(new.join(up, "root", "left").select("node", "old", F.least("root", F.coalesce("above", "root")).alias("root")))
        labels = new.select("node", "root")
        if not new.filter("old <> root").limit(1).count():
            return labels
