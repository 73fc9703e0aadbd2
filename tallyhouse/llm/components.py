"""Connected components of a large graph.

Every node has a label, at first itself. In each round the labels at both ends of an edge are
compared and the larger label is replaced by the least it meets, for all nodes that have
it; replacements are followed to their ends first. Labels only ever fall, and rounds end when
no edge has two labels. Tables are written after each step, so lineages stay short and a
lost executor costs one step.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallyhouse.operators.scratch import stage


def components(edges: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """``node, label`` for every node of ``edges`` (``a, b``), nodes being equally labelled
    exactly if connected. ``labels`` continues from an earlier result."""
    edges = stage(edges.select("a", "b"))
    nodes = edges.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    if labels is None:
        found = nodes.select("node", F.col("node").alias("label"))
    else:
        known = nodes.join(labels, "node", "left_anti").select("node", F.col("node").alias("label"))
        found = labels.select("node", "label").unionByName(known)
    labels = stage(found)
    while True:
        met = (
            edges.join(labels.toDF("a", "x"), "a")
            .join(labels.toDF("b", "y"), "b")
            .filter("x <> y")
            .groupBy(F.greatest("x", "y").alias("label"))
            .agg(F.min(F.least("x", "y")).alias("to"))
        )
        replaced = stage(met)
        if replaced.isEmpty():
            return labels
        replaced = _followed(replaced)
        labels = stage(
            labels.join(replaced, "label", "left").select("node", F.coalesce("to", "label").alias("label"))
        )


def _followed(replaced: DataFrame) -> DataFrame:
    """Replacements of replacements, by doubling steps; a label is only replaced by a less."""
    while True:
        steps = replaced.toDF("to", "next")
        longer = stage(
            replaced.join(steps, "to", "left").select(
                "label", F.coalesce("next", "to").alias("to"), F.col("next").isNotNull().alias("moved")
            )
        )
        replaced = longer.select("label", "to")
        if longer.filter("moved").isEmpty():
            return replaced
