"""Connected components of an edge table, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrail.llm.common import written


def _roots(edges: DataFrame) -> DataFrame:
    """(node, root): every node points to the smallest of itself and its neighbours, and
    pointers are followed to their ends."""
    step = written(edges.groupBy(F.col("a").alias("node")).agg(
        F.min(F.least("a", "b")).alias("root")), "cc-step")
    while True:
        next_ = step.select(F.col("node").alias("root"), F.col("root").alias("far"))
        step = written(step.join(next_, "root").select(
            "node", F.col("far").alias("root"), (F.col("far") != F.col("root")).alias("moved")),
            "cc-step")
        if step.where("moved").isEmpty():
            return step.select("node", "root")
        step = step.select("node", "root")


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of the edges (a, b): the smallest node that can be
    reached.  A round contracts every node into its root and keeps the edges between
    different roots, so the nodes left at least halve; minima are map-side combined, so a
    node with very many edges is one row per task."""
    both = edges.select("a", "b").where("a <> b")
    both = written(both.unionAll(both.select(F.col("b").alias("a"), F.col("a").alias("b")))
                   .distinct(), "cc-edges")
    labels = None
    while not both.isEmpty():
        roots = _roots(both)
        if labels is None:
            labels = roots.withColumnRenamed("root", "component")
        else:
            far = roots.select(F.col("node").alias("component"), F.col("root").alias("far"))
            labels = written(labels.join(far, "component", "left").select(
                "node", F.coalesce("far", "component").alias("component")), "cc-labels")
        at_a = roots.select(F.col("node").alias("a"), F.col("root").alias("a2"))
        at_b = roots.select(F.col("node").alias("b"), F.col("root").alias("b2"))
        both = written(both.join(at_a, "a").join(at_b, "b").where("a2 <> b2").select(
            F.col("a2").alias("a"), F.col("b2").alias("b")).distinct(), "cc-edges")
    if labels is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).where("false")
    return labels
