"""Clustering.

Assignment to the nearest centre is a narrow projection: the k centres are shared by the
tasks, which take blocks of points and centres as matrix products (or, optionally, JVM
higher-order functions) -- no point x centre join, no shuffle.  Cluster x label tables are
one ``groupBy`` (and a pivot with explicit values, so no extra job to find the distinct
labels).
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pyarrow as pa
from pyspark import RDD, SparkContext, StorageLevel, cloudpickle, inheritable_thread_target
from pyspark.ml.clustering import GaussianMixture, GaussianMixtureModel, KMeans
from pyspark.ml.common import _py2java
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Matrices, Vectors
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# executors need not have this module on their path
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def to_vector(df: DataFrame, array_col: str, out: str = "features") -> DataFrame:
    """array<float|double> column -> ML vector column (JVM-side)."""
    return df.withColumn(out, array_to_vector(F.col(array_col).cast("array<double>")))


def kmeans_best_of(data: DataFrame, k: int, max_iter: int = 10, runs: int = 10,
                   init_mode: str = "random", features: str = "features",
                   base_seed: int = 0, parallel: int = 1):
    """H1: KMeans restarted with ``runs`` seeds; the model with the lowest training cost
    (sum of squared distances) wins, the smallest seed among equals -- what the removed
    ``runs`` parameter did.

    The projected input is persisted once; with ``parallel`` above 1 so many restarts run
    at a time, as the jobs of one leave cores idle between its steps."""
    cached = data.select(features).persist()

    def restart(seed: int):
        model = KMeans(k=k, maxIter=max_iter, initMode=init_mode, seed=seed,
                       featuresCol=features).fit(cached)
        return model.summary.trainingCost, seed, model

    try:
        cached.count()  # fill the cache once, before the restarts read it
        seeds = [base_seed + r for r in range(runs)]
        if parallel > 1:
            with ThreadPoolExecutor(parallel) as pool:
                fits = list(pool.map(
                    inheritable_thread_target(data.sparkSession)(restart), seeds))
        else:
            fits = [restart(seed) for seed in seeds]
    finally:
        cached.unpersist()
    cost, _, best = min(fits, key=lambda f: f[:2])
    return best, cost


def centres_by_label(df: DataFrame, label: str,
                     vector_col: str = "features") -> list[tuple[object, list[float]]]:
    """Per-label mean vectors: one distributed aggregate, one row per label comes back."""
    rows = (df.groupBy(label).agg(Summarizer.mean(F.col(vector_col)).alias("m"))
              .select(label, vector_to_array("m").alias("m")).collect())
    return sorted(((r[label], list(r["m"])) for r in rows), key=lambda t: t[0])


def _literal_centres(centres: Sequence[Sequence[float]]) -> Column:
    return F.array(*[F.array(*[F.lit(float(x)) for x in c]) for c in centres])


#: Points and centres of one block of the matrix product: 16 MB of distances.
POINT_BLOCK, CENTRE_BLOCK = 2048, 1024


def _nearest_two(points: np.ndarray, centres: np.ndarray,
                 squares: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For every point the place of the nearest centre, and the squared distances to it and
    to the second nearest, as a matrix product gives them (that is, rounded)."""
    n = len(points)
    rows = np.arange(n)
    place, best, second = np.zeros(n, np.int64), np.full(n, np.inf), np.full(n, np.inf)
    for start in range(0, len(centres), CENTRE_BLOCK):
        d = points @ centres[start:start + CENTRE_BLOCK].T
        d *= -2.0
        d += squares[start:start + CENTRE_BLOCK]
        at = d.argmin(axis=1)
        own = d[rows, at]
        d[rows, at] = np.inf
        second = np.minimum(np.minimum(second, d.min(axis=1)), np.maximum(best, own))
        place = np.where(own < best, start + at, place)
        best = np.minimum(best, own)
    plus = (points * points).sum(axis=1)
    return place, best + plus, second + plus


def _exact_nearest(points: np.ndarray, centres: np.ndarray,
                   tie_decimals: int) -> tuple[np.ndarray, np.ndarray]:
    """The place of the nearest centre and its distance, centre by centre; of distances equal
    after rounding the first centre's."""
    key, place = np.full(len(points), np.inf), np.full(len(points), -1)
    dist = np.full(len(points), np.nan)
    for j in range(len(centres)):
        d = np.sqrt(((points - centres[j]) ** 2).sum(axis=1))
        rounded = np.round(d, tie_decimals)
        better = rounded < key
        key, place = np.where(better, rounded, key), np.where(better, j, place)
        dist = np.where(better, d, dist)
    return place, dist


def _nearest_blocked(points: np.ndarray, centres: np.ndarray, squares: np.ndarray,
                     tie_decimals: int) -> tuple[np.ndarray, np.ndarray]:
    """As :func:`_exact_nearest`, from matrix products: only points whose two nearest centres
    are as near to each other as rounding could have swapped them are measured again."""
    place, best, second = _nearest_two(points, centres, squares)
    dist = np.sqrt(((points - centres[place]) ** 2).sum(axis=1))
    d = points.shape[1]
    # what the products can be off by, and what distances can differ by and still be a tie
    off = 8 * (d + 4) * np.finfo(float).eps * ((points * points).sum(axis=1) + squares.max())
    close = np.sqrt(np.maximum(second - off, 0)) <= (
        np.sqrt(np.maximum(best + off, 0)) + 2 * 10.0 ** -tie_decimals)
    again = np.flatnonzero(close | ~np.isfinite(dist) | ~np.isfinite(off))
    if len(again):
        place[again], dist[again] = _exact_nearest(points[again], centres, tie_decimals)
    return place, dist


def _nearest_numpy(spark, centres: np.ndarray, ids: np.ndarray, tie_decimals: int):
    """An Arrow function from points to (id, distance).  The centres, sorted by id so that
    ties keep the lowest, are one broadcast of k x d x 8 bytes that tasks share."""
    order = np.argsort(ids, kind="stable")
    shared = spark.sparkContext.broadcast((centres[order], ids[order]))

    @F.arrow_udf("struct<id:bigint,d:double>")
    def nearest(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        cs, cid = shared.value
        squares = (cs * cs).sum(axis=1)
        for batch in batches:
            there = np.flatnonzero(batch.is_valid().to_numpy(zero_copy_only=False))
            place, dist = np.full(len(batch), -1), np.full(len(batch), np.nan)
            flat = batch.drop_null().flatten().to_numpy(zero_copy_only=False)
            points = flat.reshape(len(there), -1) if len(there) else flat
            for start in range(0, len(there), POINT_BLOCK):
                rows = there[start:start + POINT_BLOCK]
                place[rows], dist[rows] = _nearest_blocked(
                    points[start:start + POINT_BLOCK], cs, squares, tie_decimals)
            yield pa.StructArray.from_arrays(
                [pa.array(cid[place], pa.int64(), mask=place < 0),
                 pa.array(dist, pa.float64())], ["id", "d"])

    return nearest


def assign_nearest(df: DataFrame, point_col: str, centres: Sequence[Sequence[float]],
                   ids: Sequence[int] | None = None, cluster_col: str = "cluster",
                   distance_col: str = "distance", tie_decimals: int = 9,
                   method: str = "numpy") -> DataFrame:
    """C2 + H2: nearest centre by Euclidean distance for every row, as a projection.

    There is no point x centre join and no shuffle.  Ties (distances equal after rounding to
    ``tie_decimals``) go to the lowest id; a point without a finite distance has no cluster.
    ``method="numpy"`` (default) takes blocks of points x centres as matrix products and
    measures near ties again one by one; the centres are one broadcast of k x d x 8 bytes
    (5,000 centres of 64 dimensions: 2.6 MB).  ``method="expressions"`` is the same
    computation as JVM higher-order functions, for few centres: they are part of the plan."""
    ids = list(range(len(centres))) if ids is None else list(ids)
    if method == "numpy":
        udf = _nearest_numpy(df.sparkSession, np.asarray(centres, dtype=np.float64),
                             np.asarray(ids, dtype=np.int64), tie_decimals)
        best = udf(F.col(point_col).cast("array<double>"))
        return (df.withColumn("_best", best)
                  .withColumn(cluster_col, F.col("_best.id").cast("int"))
                  .withColumn(distance_col, F.col("_best.d"))
                  .drop("_best"))
    if method != "expressions":
        raise ValueError(f"unknown method {method!r}")
    cs = _literal_centres(centres)
    id_arr = F.array(*[F.lit(int(i)) for i in ids])
    p = F.col(point_col).cast("array<double>")

    def dist(c: Column) -> Column:
        sq = F.zip_with(p, c, lambda a, b: (a - b) * (a - b))
        return F.sqrt(F.aggregate(sq, F.lit(0.0), lambda acc, x: acc + x))

    # distances once per centre, then the (rounded distance, id) minimum
    dists = F.transform(cs, dist)
    keyed = F.transform(F.col("_d"), lambda d, i: F.struct(
        F.round(d, tie_decimals).alias("key"), F.element_at(id_arr, i + 1).alias("id"),
        d.alias("d")))
    return (df.withColumn("_d", dists)
              .withColumn("_best", F.array_min(keyed))
              .withColumn(cluster_col, F.col("_best.id"))
              .withColumn(distance_col, F.col("_best.d"))
              .drop("_d", "_best"))


def distance_sums(assigned: DataFrame, distance_col: str = "distance") -> DataFrame:
    """``sum_distance`` (what the original printed as its "sum of squared
    error") and ``sum_sq_distance`` (the real one, KMeans' training cost)."""
    d = F.col(distance_col)
    return assigned.agg(F.count(F.lit(1)).alias("n"), F.sum(d).alias("sum_distance"),
                        F.sum(d * d).alias("sum_sq_distance"))


def cluster_label_counts(assigned: DataFrame, cluster_col: str, label: str) -> DataFrame:
    """``(cluster, label, n)``."""
    return (assigned.groupBy(F.col(cluster_col).alias("cluster"), F.col(label).alias("label"))
                    .agg(F.count(F.lit(1)).alias("n")))


def crosstab(assigned: DataFrame, cluster_col: str, label: str,
             label_values: Sequence[object], clusters: Sequence[int] | None = None,
             prefix: str = "label_") -> DataFrame:
    """Cluster x label grid, zero-filled; rows = predicted clusters, columns = real
    labels given explicitly (no job to discover them).  ``clusters`` adds all-zero rows
    for clusters that received no point."""
    grid = (assigned.groupBy(F.col(cluster_col).alias("cluster"))
                    .pivot(label, list(label_values)).count())
    for v in label_values:
        grid = grid.withColumnRenamed(str(v), f"{prefix}{v}")
    if clusters is not None:
        spark = assigned.sparkSession
        all_c = spark.createDataFrame([(int(c),) for c in clusters], "cluster int")
        grid = all_c.join(grid.withColumn("cluster", F.col("cluster").cast("int")),
                          "cluster", "left")
    cols = [F.coalesce(F.col(f"{prefix}{v}"), F.lit(0)).cast("bigint").alias(f"{prefix}{v}")
            for v in label_values]
    return grid.select("cluster", *cols)


#: Bytes of one block of points of a mixture: what a step holds stays in a core's cache.
MIXTURE_BLOCK = 64 << 10
_EPS = float(np.finfo(float).eps)


def _point_blocks(rows: DataFrame, features: str, dims: int) -> RDD:
    """The vectors as blocks of doubles (dims x points), dealt evenly over the cores."""
    size = max(1, MIXTURE_BLOCK // (8 * dims))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)
            yield pa.record_batch([pa.array(
                [points[i:i + size].T.tobytes() for i in range(0, len(points), size)],
                pa.binary())], ["block"])

    parts = max(rows.sparkSession.sparkContext.defaultParallelism, rows.rdd.getNumPartitions())
    blocks = rows.select(vector_to_array(features).alias("x")).mapInArrow(pack, "block binary")
    return blocks.repartition(parts).rdd.map(lambda r: bytes(r[0]))


def _densities(covs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per covariance the matrix that whitens a difference from the mean and the logarithm of
    the density there; directions without variance take no part."""
    roots, logs = [], []
    for cov in covs:
        values, vectors = np.linalg.eigh(cov)
        there = values > _EPS * values.max() * len(values)
        if not there.any():
            raise ValueError("a component of the mixture has no variance")
        roots.append(np.where(there, 1 / np.sqrt(np.where(there, values, 1)), 0)[:, None] * vectors.T)
        logs.append(-0.5 * (len(values) * np.log(2 * np.pi) + np.log(values[there]).sum()))
    return np.array(roots), np.array(logs)


def _expectation(blocks: Iterator[bytes], weights: np.ndarray, means: np.ndarray,
                 roots: np.ndarray, logs: np.ndarray):
    """Over the points of some blocks: the log likelihood, and per component the sums of the
    shares, of the differences from its mean and of their products."""
    k, dims = means.shape
    likelihood, s0, s1, s2 = 0.0, np.zeros(k), np.zeros((k, dims)), np.zeros((k, dims, dims))
    for block in blocks:
        off = np.frombuffer(block).reshape(dims, -1) - means[:, :, None]
        white = roots @ off
        white *= white
        share = white.sum(axis=1)
        share *= -0.5
        share += logs[:, None]
        np.exp(share, out=share)
        share *= weights[:, None]
        share += _EPS
        total = share.sum(axis=0)
        share /= total
        likelihood += float(np.log(total).sum())
        np.multiply(off, share[:, None, :], out=white)
        s0 += share.sum(axis=1)
        s1 += white.sum(axis=2)
        s2 += white @ off.transpose(0, 2, 1)
    return likelihood, s0, s1, s2


def _mixture_model(start, estimator, weights: np.ndarray, means: np.ndarray, covs: np.ndarray):
    """Spark's model of these components, with the parameters of ``estimator``."""
    sc = SparkContext._active_spark_context
    ml = sc._jvm.org.apache.spark.ml
    kinds = ml.stat.distribution.MultivariateGaussian
    gaussians = sc._gateway.new_array(kinds, len(weights))
    shares = sc._gateway.new_array(sc._gateway.jvm.double, len(weights))
    for i, (w, m, c) in enumerate(zip(weights, means, covs)):
        shares[i] = float(w)
        gaussians[i] = kinds(_py2java(sc, Vectors.dense(m)), _py2java(
            sc, Matrices.dense(len(m), len(m), c.ravel().tolist())))
    model = GaussianMixtureModel(ml.clustering.GaussianMixtureModel(start.uid, shares, gaussians))
    return estimator._copyValues(model._resetUid(start.uid))


def gaussian_mixture(data: DataFrame, k: int = 6, max_iter: int = 100, tol: float = 1e-3,
                     seed: int = 0, features: str = "features"):
    """H4: Gaussian mixture by EM (the RDD API's defaults: 100 iterations, tol 1e-3), as
    Spark's estimator fits it, and as its model.

    The components the steps begin from are those of the estimator, which also checks the
    vectors.  The points are then kept as blocks of doubles (8 bytes a component), and a
    step takes a block as matrix products; what reaches the driver is, per part, k x d x d
    sums.  Sums are taken of differences from the means, so that nothing cancels."""
    estimator = GaussianMixture(k=k, maxIter=0, tol=tol, seed=seed, featuresCol=features)
    rows = data.select(features).persist()
    try:
        start = estimator.fit(rows)
        weights = np.array(start.weights)
        means = np.array([g.mean.toArray() for g in start.gaussians])
        covs = np.array([g.cov.toArray() for g in start.gaussians])
        blocks = _point_blocks(rows, features, means.shape[1]).persist(
            StorageLevel.MEMORY_AND_DISK)
        blocks.count()  # fill the cache once, before the steps read it
    finally:
        rows.unpersist()
    try:
        likelihood, before, done = -sys.float_info.max, 0.0, 0
        while done < max_iter and abs(likelihood - before) > tol:
            now = (weights, means, *_densities(covs))
            sums = blocks.mapPartitions(lambda part, now=now: [_expectation(part, *now)]).collect()
            before, (likelihood, s0, s1, s2) = likelihood, (sum(s) for s in zip(*sums))
            move = s1 / s0[:, None]
            weights, means = s0 / s0.sum(), means + move
            covs = s2 / s0[:, None, None] - move[:, :, None] * move[:, None, :]
            covs = (covs + covs.transpose(0, 2, 1)) / 2
            done += 1
    finally:
        blocks.unpersist()
    estimator.setMaxIter(max_iter)
    return _mixture_model(start, estimator, weights, means, covs)


def mixture_components(model) -> list[tuple[int, float, list[float], list[list[float]]]]:
    """``(component, weight, mean, covariance)`` -- k x d x d values on the driver."""
    rows = model.gaussiansDF.collect()
    return [(i, float(w), list(r["mean"].toArray()), r["cov"].toArray().tolist())
            for i, (w, r) in enumerate(zip(model.weights, rows))]


def mixture_moments(model) -> tuple[list[float], list[list[float]]]:
    """Overall mean and covariance implied by a fitted mixture:
    ``m = sum w_k mu_k``, ``S = sum w_k (S_k + mu_k mu_k^T) - m m^T``.  After an EM step
    they equal the data's mean and population covariance."""
    comps = mixture_components(model)
    w = np.array([c[1] for c in comps])
    mus = np.array([c[2] for c in comps])
    covs = np.array([c[3] for c in comps])
    m = (w[:, None] * mus).sum(axis=0)
    second = (w[:, None, None] * (covs + np.einsum("ki,kj->kij", mus, mus))).sum(axis=0)
    return m.tolist(), (second - np.outer(m, m)).tolist()
