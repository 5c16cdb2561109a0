"""Connected components of an edge table, by contraction over written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm.tables import settle


def _contracted(edges: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """One round: nodes with their label (a smaller node they are connected with, or themselves), and the edges left.

    Every node hooks onto its smallest neighbour if that is smaller, and follows the hooks four
    steps. The minimum is combined before the shuffle, and the joins split the edges of a hot
    node (skew join): nothing gathers a node's neighbours in one place.
    """
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    hooks = settle(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("label")).select(
        "node", F.least("node", "label").alias("label")), name)
    for _ in range(2):
        ahead = hooks.select(F.col("node").alias("label"), F.col("label").alias("next"))
        hooks = hooks.join(ahead, "label").select("node", F.col("next").alias("label"))
    labels = settle(hooks, name)
    named = lambda end: labels.select(F.col("node").alias(end), F.col("label").alias(f"new_{end}"))
    left = edges.join(named("a"), "a").join(named("b"), "b").filter("new_a != new_b").select(
        F.greatest("new_a", "new_b").alias("a"), F.least("new_a", "new_b").alias("b")).distinct()
    return labels, settle(left, name)


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """``node`` and ``component``, the smallest node it is connected with, for every node of edges (a, b).

    Rounds of contraction until no edge is left between labels; each round's graph is at most half as
    large. Loops count as nothing.
    """
    left = settle(edges.filter("a != b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), name)
    found = None
    while True:
        labels, left = _contracted(left, name)
        if found is None:
            found = labels.select("node", F.col("label").alias("component"))
        else:
            onward = labels.select(F.col("node").alias("component"), F.col("label").alias("next"))
            found = settle(found.join(onward, "component", "left").select(
                "node", F.coalesce("next", "component").alias("component")), name)
        if left.isEmpty():
            return found
