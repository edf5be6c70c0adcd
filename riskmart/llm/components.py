"""Connected components of a table of links, without any of it on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from riskmart.session import written


def components(links: DataFrame) -> DataFrame:
    """(node, label) of each node in ``links`` (a long, b long): the label is the same for all that hang together.

    Each round merges every node into the least of its neighbours and itself and draws the links anew between what
    is left, until no link is left; the labels follow those steps back. Links to oneself give a node of its own."""
    edges, steps = links.select("a", "b"), []
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        step = written(both.groupBy("a").agg(F.min("b").alias("least"))
                       .select(F.col("a").alias("node"), F.least("a", "least").alias("label")), "components")
        steps.append(step)
        ends = [step.select(F.col("node").alias(c), F.col("label").alias(f"new_{c}")) for c in ("a", "b")]
        edges = written(edges.join(ends[0], "a").join(ends[1], "b").where("new_a <> new_b")
                        .select(F.col("new_a").alias("a"), F.col("new_b").alias("b")).distinct(), "component-links")
        if edges.isEmpty():
            break
    labels = steps.pop()
    while steps:
        labels = labels.select(F.col("node").alias("label"), F.col("label").alias("root"))
        labels = steps.pop().join(labels, "label", "left").select("node", F.coalesce("root", "label").alias("label"))
    return labels
