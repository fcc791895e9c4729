"""Graph clustering (H5, B15): power iteration clustering over a weighted edge list."""

from __future__ import annotations

from pyspark.ml.clustering import PowerIterationClustering
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def normalise_edges(edges: DataFrame, src: str = "src", dst: str = "dst",
                    weight: str = "weight") -> DataFrame:
    """Undirected, loop-free, positive edges with ``src < dst``; parallel edges summed.

    The similarity matrix PIC needs is symmetric: one row per unordered pair suffices."""
    a, b = F.least(F.col(src), F.col(dst)), F.greatest(F.col(src), F.col(dst))
    return (edges.where((F.col(src) != F.col(dst)) & (F.col(weight) > 0))
                 .groupBy(a.alias("src"), b.alias("dst"))
                 .agg(F.sum(weight).alias("weight")))


def name_by_smallest(assignments: DataFrame) -> DataFrame:
    """``(id, cluster)`` with every cluster named after its smallest vertex, so that equal
    partitions have equal names whatever numbers the clustering gave them."""
    names = assignments.groupBy("cluster").agg(F.min("id").alias("name"))
    return assignments.join(F.broadcast(names), "cluster").select(
        "id", F.col("name").alias("cluster"))


def dropped_edges(edges: DataFrame, src: str = "src", dst: str = "dst",
                  weight: str = "weight") -> DataFrame:
    """What :func:`normalise_edges` leaves out: ``(n_edges, n_null, n_loops, n_no_weight)``,
    each edge counted under the first that holds."""
    null = F.col(src).isNull() | F.col(dst).isNull() | F.col(weight).isNull()
    loop = ~null & (F.col(src) == F.col(dst))
    return edges.agg(
        F.count(F.lit(1)).alias("n_edges"), F.count_if(null).alias("n_null"),
        F.count_if(loop).alias("n_loops"),
        F.count_if(~null & ~loop & ~(F.col(weight) > 0)).alias("n_no_weight"))


def power_iteration_clusters(edges: DataFrame, k: int = 2, max_iter: int = 10,
                             init_mode: str = "random", src: str = "src", dst: str = "dst",
                             weight: str = "weight") -> DataFrame:
    """H5: ``(id, cluster)`` for every vertex of the similarity graph."""
    pic = PowerIterationClustering(k=k, maxIter=max_iter, initMode=init_mode, srcCol=src,
                                   dstCol=dst, weightCol=weight)
    return pic.assignClusters(edges)


def describe_assignments(assignments: DataFrame) -> DataFrame:
    """The ``"id -> cluster"`` text next to the columns."""
    return assignments.withColumn(
        "text", F.concat_ws(" -> ", F.col("id").cast("string"), F.col("cluster").cast("string")))


def edges_to_lines(edges: DataFrame, sep: str = " ") -> DataFrame:
    """Render ``src dst weight`` lines (the edge-list text format) as ``value``."""
    return edges.select(F.concat_ws(sep, F.col("src").cast("string"), F.col("dst").cast("string"),
                                    F.col("weight").cast("string")).alias("value"))
