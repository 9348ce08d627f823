"""Connected components of a link table, by label propagation with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterloom.llm.common import stage
from meterloom.operators.joins import lookup_join


def components(links: DataFrame) -> DataFrame:
    """``node``, ``label`` (smallest node reachable) for every node of ``links`` (``a``, ``b``).

    Every round takes the smallest label among a node's neighbours (a sum-like aggregate, so a
    node with very many links arrives as one row per task) and then that label's own label,
    which halves the remaining distance. Rounds are written tables, nothing reaches the driver
    but whether a label changed. No links: no rows. Null ends and self links are ignored.
    """
    ends = links.dropna(subset=["a", "b"]).filter("a <> b")
    both = stage(
        ends.select("a", "b").unionByName(ends.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(),
        "links",
    )
    labels = stage(
        both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select(
            "node", F.least("node", "m").alias("label"), F.lit(True).alias("moved")
        ),
        "labels",
    )
    while not labels.filter("moved").isEmpty():
        near = (
            both.join(labels.select(F.col("node").alias("b"), "label"), "b")
            .groupBy("a")
            .agg(F.min("label").alias("m"))
        )
        lower = labels.join(near.withColumnRenamed("a", "node"), "node", "left").select(
            "node", F.col("label").alias("was"), F.least("label", "m").alias("label")
        )
        # A label is itself a node, so its own label of the round before can be looked up.
        # The label of a large component is one key, so the join is salted unless it is small.
        onward = labels.filter("label < node").select(F.col("node").alias("root"), F.col("label").alias("onward"))
        jumped = lookup_join(lower, onward, {"label": "root"}, ["node"]).select(
            "node", F.least("label", "onward").alias("label"), "was"
        )
        labels = stage(jumped.select("node", "label", (F.col("label") < F.col("was")).alias("moved")), "labels")
    return labels.select("node", "label")
