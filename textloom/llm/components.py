"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.storage import materialise


def connected(links: DataFrame) -> DataFrame:
    """``(node, label)`` for every node of ``links(a, b)``; a label is one node of the component.

    Each round hands every node to its smallest neighbour (or itself) and draws the links
    between those, so the links shrink until none is left. Nothing reaches the driver but
    the number of links. A node of many links takes part in sums by partial aggregation
    and in joins that Spark can split.
    """
    links = materialise(links.filter("a <> b").distinct(), "links")
    chosen: list[DataFrame] = []
    while not links.isEmpty():
        both = links.union(links.select("b", "a"))
        step = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("_next"))
        step = materialise(step.select("node", F.least("node", "_next").alias("label")), "component-step")
        chosen.append(step)
        left, right = step.toDF("a", "x"), step.toDF("b", "y")
        moved = links.join(left, "a").join(right, "b").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
        links = materialise(moved.filter("a <> b").distinct(), "links")
    if not chosen:
        return links.select(F.col("a").alias("node"), F.col("b").alias("label"))
    labels = chosen[0]
    for step in chosen[1:]:
        further = step.toDF("label", "_further")
        labels = labels.join(further, "label", "left").select("node", F.coalesce("_further", "label").alias("label"))
    return labels
