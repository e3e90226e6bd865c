"""Connected components of a table of links, on Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from starmill.llm.tables import staged


def components(links: DataFrame) -> DataFrame:
    """``(node, label)`` for every node of ``links(x, y)``; label is the smallest node it reaches.

    Each round every node, and the node its label names, takes the smallest label across its links,
    and labels are then followed once. Chains shrink geometrically, so rounds follow the logarithm
    of the longest path. Only minima are aggregated, with map-side combine; a node with very many
    links costs no task more than its share.
    """
    both = staged(links.select("x", "y").union(links.select("y", "x")).distinct(), "links")
    first = F.least(F.min("y"), F.col("x")).alias("label")
    labels = staged(both.groupBy("x").agg(first).select(F.col("x").alias("node"), "label"), "labels")
    while True:
        at_x = labels.select(F.col("node").alias("x"), F.col("label").alias("label_x"))
        at_y = labels.select(F.col("node").alias("y"), F.col("label").alias("label_y"))
        across = both.join(at_x, "x").join(at_y, "y").filter("label_x <> label_y")
        offers = across.select(F.explode(F.array("x", "label_x")).alias("node"), "label_y")
        best = staged(offers.groupBy("node").agg(F.min("label_y").alias("offer")), "offers")
        if best.isEmpty():
            return labels
        lower = labels.join(best, "node", "left").select("node", F.least("label", "offer").alias("label"))
        jump = lower.select(F.col("node").alias("label"), F.col("label").alias("further"))
        labels = staged(lower.join(jump, "label").select("node", F.col("further").alias("label")), "labels")
