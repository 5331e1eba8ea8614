"""Connected components of a graph given as edges, by hooking and pointer jumping in Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import Scratch


def flattened(parents: DataFrame, scratch: Scratch) -> DataFrame:
    """Follow ``(node, parent)`` to the root; each round doubles the length of the steps."""
    while True:
        up = parents.select(F.col("node").alias("n"), F.col("parent").alias("p"))
        further = parents.join(up, parents.parent == up.n, "left")
        step = scratch.save(further.select("node", F.coalesce("p", "parent").alias("parent"), F.col("p").isNotNull().alias("moved")), "jump")
        scratch.drop(parents)
        parents = step.select("node", "parent")
        if step.filter("moved").isEmpty():
            return parents


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """``(node, label)`` for every node of the edges ``(a, b)``; the label is the least node.

    In each round every root hooks to its least smaller neighbour; chains of hooks are then
    flattened and the edges rewritten to roots. A round at least halves the roots that still
    have edges, so the number of rounds is logarithmic; nothing is gathered on the driver.
    """
    live = edges.filter("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    live = scratch.save(live, "edges")
    nodes = live.select(F.col("a").alias("node")).union(live.select(F.col("b").alias("node"))).distinct()
    labels = scratch.save(nodes.select("node", F.col("node").alias("label")), "labels")
    while not live.isEmpty():
        hooks = scratch.save(live.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("parent")), "hooks")
        roots = flattened(hooks, scratch).select(F.col("node").alias("old"), F.col("parent").alias("new"))
        relabelled = labels.join(roots, labels.label == roots.old, "left").select("node", F.coalesce("new", "label").alias("label"))
        after = scratch.save(relabelled, "labels")
        moved = live
        for end in ("a", "b"):
            moved = moved.join(roots, F.col(end) == F.col("old"), "left").withColumn(end, F.coalesce("new", end)).drop("old", "new")
        moved = moved.filter("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        rest = scratch.save(moved, "edges")
        scratch.drop(labels, live, roots)
        labels, live = after, rest
    return labels
