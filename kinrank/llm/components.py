"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinrank.session import forget, written


def components(links: DataFrame) -> DataFrame:
    """``node, component`` for both ends of every link ``a, b``; the component is its
    smallest node.

    Each round takes the smallest label among a node's neighbours, then the label of that
    label, and writes the labels to the shared folder, where only the last ones stay; the driver
    sees only whether any has changed. Links to nulls are left out; no links give no rows.
    """
    links = links.filter("a IS NOT NULL AND b IS NOT NULL AND a <> b")
    both = written(
        links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    )
    labels = written(both.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("component")))
    while True:
        near = (
            both.join(labels, F.col("b") == F.col("node"))
            .groupBy("a")
            .agg(F.min("component").alias("least"))
        )
        lower = labels.join(near, F.col("node") == F.col("a")).select(
            "node", F.least("component", "least").alias("lower"), F.col("component").alias("was")
        )
        heads = labels.select(F.col("node").alias("head"), F.col("component").alias("of_head"))
        before = labels
        labels = written(
            lower.join(heads, F.col("lower") == F.col("head")).select(
                "node", F.least("lower", "of_head").alias("component"), "was"
            )
        )
        forget(before)
        if labels.filter("component <> was").isEmpty():
            forget(both)
            return labels.select("node", "component")
