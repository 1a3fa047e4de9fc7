"""Connected components of a bipartite peptide-protein graph."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quantweave.shared import materialise


def connected_components(edges: DataFrame, left: str = "peptide", right: str = "protein") -> DataFrame:
    """Label each right-hand node with the smallest right-hand node it is connected to.

    Each left node becomes a star around its smallest right-hand node. The distinct spokes, far fewer than the edges
    where left nodes share many of them, then carry the labels: every hub takes the smallest label among its spokes, every
    right node the smallest among its hubs; after each round labels are short-cut through the label of their label, so
    long chains need few rounds. The tables of a round are written to the shared folder, which also lets Spark see their
    size and split a node or label that holds much of the data. Returns ``right`` and ``component``.
    """
    edges = materialise(edges.select(F.col(left).alias("_l"), F.col(right).alias("_r")).dropna(), "edges")
    hubs = materialise(edges.groupBy("_l").agg(F.min("_r").alias("_hub")), "hubs")
    links = materialise(edges.join(hubs, on="_l").select(F.col("_hub").alias("_l"), "_r").distinct(), "links")
    return connect_spokes(links).select(F.col("_r").alias(right), F.col("_c").alias("component"))


def connect_spokes(links: DataFrame) -> DataFrame:
    """Label (``_c``) each node ``_r`` of distinct spokes from a hub ``_l``; a hub is among its own spokes."""
    labels = materialise(links.groupBy("_r").agg(F.min("_l").alias("_c")), "labels")
    while True:
        near = materialise(links.join(labels, on="_r").groupBy("_l").agg(F.min("_c").alias("_c")), "near")
        spread = links.join(near, on="_l").groupBy("_r").agg(F.min("_c").alias("_c"))
        # Hooking: a label that meets a smaller one passes it to everything under that label, so that whole groups merge.
        met = (
            labels.withColumnRenamed("_c", "_old")
            .join(spread, on="_r")
            .groupBy("_old")
            .agg(F.min("_c").alias("_met"))
        )
        met = materialise(met, "met")
        hooked = labels.join(met, on=F.col("_c") == F.col("_old"), how="left").select(
            "_r", F.col("_c").alias("_was"), F.least("_c", "_met").alias("_c")
        )
        through = hooked.select(F.col("_r").alias("_c"), F.col("_c").alias("_next"))
        jumped = hooked.join(through, on="_c", how="left").select(
            "_r", "_was", F.least("_c", "_next").alias("_c")
        )
        latest = materialise(jumped, "labels")
        if latest.filter(F.col("_c") != F.col("_was")).isEmpty():
            return latest.select("_r", "_c")
        labels = latest.select("_r", "_c")
