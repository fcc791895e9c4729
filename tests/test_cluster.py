"""Clustering and graph invariants."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.clustering import GaussianMixture
from pyspark.sql import functions as F

from vitrail.operators import cluster, graph
from vitrail.plans import catalog, oracles

from .conftest import SF001


def _blobs(spark, n=60):
    rng = np.random.default_rng(4)
    rows = []
    for i in range(n):
        c = i % 3
        p = rng.normal(size=2) * 0.2 + np.array([c * 5.0, -c * 3.0])
        rows.append((i, c, [float(x) for x in p]))
    return spark.createDataFrame(rows, "id long, label int, p array<double>")


def test_best_of_runs_cost_equals_sum_of_squares(spark):
    df = cluster.to_vector(_blobs(spark), "p")
    model, cost = cluster.kmeans_best_of(df, k=3, max_iter=10, runs=3)
    centres = [list(c) for c in model.clusterCenters()]
    assigned = cluster.assign_nearest(df, "p", centres)
    sums = cluster.distance_sums(assigned).collect()[0]
    assert sums.sum_sq_distance == pytest.approx(cost, rel=1e-9)
    ours = {r.id: r.cluster for r in assigned.collect()}
    theirs = {r.id: r.prediction for r in model.transform(df).collect()}
    assert ours == theirs


@pytest.mark.parametrize("method", ["numpy", "expressions"])
def test_assign_nearest_ties_go_to_lowest_id(spark, method):
    df = spark.createDataFrame([(0, [0.0, 0.0])], "id int, p array<double>")
    r = cluster.assign_nearest(df, "p", [[1.0, 0.0], [-1.0, 0.0]], ids=[7, 3],
                               method=method).collect()[0]
    assert r.cluster == 3 and r.distance == pytest.approx(1.0)


def test_assign_nearest_methods_agree_and_keep_null_rows(spark):
    df = _blobs(spark).union(spark.createDataFrame([(99, 0, None)], "id long, label int, p array<double>"))
    centres = [[0.0, 0.0], [5.0, -3.0], [10.0, -6.0], [2.5, -1.5]]
    a = {r.id: (r.cluster, r.distance) for r in cluster.assign_nearest(df, "p", centres).collect()}
    b = {r.id: (r.cluster, r.distance) for r in
         cluster.assign_nearest(df, "p", centres, method="expressions").collect()}
    assert a.keys() == b.keys() and len(a) == 61
    assert a[99][0] is None
    for k in a:
        if k != 99:
            assert a[k][0] == b[k][0] and a[k][1] == pytest.approx(b[k][1], abs=1e-12)


def test_centres_by_label_and_crosstab(spark):
    df = cluster.to_vector(_blobs(spark), "p")
    centres = cluster.centres_by_label(df, "label")
    assert [lab for lab, _ in centres] == [0, 1, 2]
    assigned = cluster.assign_nearest(df, "p", [c for _, c in centres], ids=[0, 1, 2])
    grid = cluster.crosstab(assigned, "cluster", "label", [0, 1, 2, 3], clusters=[0, 1, 2, 5])
    rows = {r.cluster: r for r in grid.collect()}
    assert rows[5].label_0 == 0 and rows[0].label_0 == 20 and rows[1].label_3 == 0
    counts = cluster.cluster_label_counts(assigned, "cluster", "label")
    assert counts.agg(F.sum("n")).first()[0] == 60


def test_gmm_weights_and_moments(spark):
    df = cluster.to_vector(_blobs(spark, 90), "p")
    model = cluster.gaussian_mixture(df, k=3, seed=1)
    assert sum(model.weights) == pytest.approx(1.0)
    mean, cov = cluster.mixture_moments(model)
    pts = np.array([r.p for r in _blobs(spark, 90).collect()])
    assert mean == pytest.approx(list(pts.mean(axis=0)), rel=1e-6)
    assert np.allclose(cov, np.cov(pts.T, bias=True), rtol=1e-5, atol=1e-8)


def test_gmm_is_the_one_of_sparks_estimator(spark):
    df = cluster.to_vector(_blobs(spark, 300), "p")
    got = cluster.gaussian_mixture(df, k=3, max_iter=6, tol=0.0, seed=1)
    want = GaussianMixture(k=3, maxIter=6, tol=0.0, seed=1).fit(df.persist())
    assert list(got.weights) == pytest.approx(list(want.weights), rel=1e-6)
    for (_, _, m, c), (_, _, wm, wc) in zip(cluster.mixture_components(got),
                                            cluster.mixture_components(want)):
        assert np.allclose(m, wm, rtol=1e-6) and np.allclose(c, wc, rtol=1e-5, atol=1e-8)
    one, other = (m.transform(df).select("prediction").collect() for m in (got, want))
    assert one == other and got.getMaxIter() == 6


def test_gmm_steps_take_blocks_of_all_cores(spark):
    # the points come in one partition; the steps' blocks must not stay in it
    df = cluster.to_vector(_blobs(spark, 3000).coalesce(1), "p")
    blocks = cluster._point_blocks(df, "features", len(_blobs(spark, 3).first().p))
    assert blocks.getNumPartitions() >= spark.sparkContext.defaultParallelism
    assert sum(len(b) for b in blocks.collect()) == 8 * 3000 * len(_blobs(spark, 3).first().p)


def test_moments_are_returned_with_the_variances(spark):
    """the means themselves, in eight digits, and the variances."""
    rows = catalog.q_gmm_moments(spark, SF001).collect()
    li = spark.read.parquet(f"{SF001}/lineitem.parquet")
    for i, c in enumerate(catalog.LINEITEM_FEATURES):
        mean, var = li.agg(F.avg(c), F.var_pop(c)).first()
        got = [(r.mean_i, r.var_i) for r in rows if r.i == i]
        assert len(got) == 4 and all(x == pytest.approx((mean, var), rel=1e-7) for x in got)
    assert "avg(" in oracles.registry()["gmm_moments"] and "var_pop(" in oracles.registry()["gmm_moments"]


def test_power_iteration_two_cliques(spark):
    edges = []
    for block, (start, size) in enumerate(((0, 12), (12, 20))):
        nodes = range(start, start + size)
        edges += [(a, b, 1.0) for a in nodes for b in nodes if a < b]
    edges.append((0, 12, 0.001))
    df = spark.createDataFrame(edges, "src long, dst long, weight double")
    for mode in ("random", "degree"):
        out = {r.id: r.cluster for r in graph.power_iteration_clusters(
            graph.normalise_edges(df), k=2, max_iter=20, init_mode=mode).collect()}
        first = {out[i] for i in range(12)}
        second = {out[i] for i in range(12, 32)}
        assert len(first) == 1 and len(second) == 1 and first != second


def test_normalise_edges_and_text(spark):
    df = spark.createDataFrame([(2, 1, 1.0), (1, 2, 0.5), (3, 3, 1.0), (4, 5, 0.0)],
                               "src long, dst long, weight double")
    rows = [tuple(r) for r in graph.normalise_edges(df).collect()]
    assert rows == [(1, 2, 1.5)]
    a = spark.createDataFrame([(1, 0)], "id long, cluster int")
    assert graph.describe_assignments(a).first().text == "1 -> 0"


def _scan(points, centres, decimals=9):
    d = np.sqrt(((points[:, None, :] - centres[None, :, :]) ** 2).sum(axis=2))
    return np.round(d, decimals).argmin(axis=1)


def test_blocked_search_equals_the_scan_with_many_centres():
    rng = np.random.default_rng(1)
    centres = rng.standard_normal((2500, 8)) + 50.0  # large norms: products lose digits
    points = np.concatenate([rng.standard_normal((300, 8)) + 50.0, centres[:50],
                             (centres[:50] + centres[50:100]) / 2])  # centres and near ties
    squares = (centres * centres).sum(axis=1)
    place, dist = cluster._nearest_blocked(points, centres, squares, 9)
    assert (place == _scan(points, centres)).all()
    assert np.allclose(dist, np.sqrt(((points - centres[place]) ** 2).sum(axis=1)), atol=0)


def test_blocked_search_takes_the_first_of_equal_centres():
    rng = np.random.default_rng(2)
    grid = rng.integers(-2, 3, (1500, 3)).astype(float)  # most centres stand there many times
    points = rng.integers(-2, 3, (200, 3)) / 2
    place, _ = cluster._nearest_blocked(points, grid, (grid * grid).sum(axis=1), 9)
    assert (place == _scan(points, grid)).all()


def test_many_centres_in_a_frame(spark):
    rng = np.random.default_rng(3)
    centres = rng.standard_normal((1200, 4))
    points = rng.standard_normal((500, 4))
    df = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(points)]
                               + [(-1, None), (-2, [0.0, float("nan"), 0.0, 0.0])],
                               "id long, p array<double>")
    got = {r.id: r.cluster for r in cluster.assign_nearest(
        df, "p", centres.tolist(), [5 * j for j in range(1200)]).collect()}
    assert got.pop(-1) is None and got.pop(-2) is None
    want = _scan(points, centres)
    assert got == {i: 5 * int(w) for i, w in enumerate(want)}


def test_many_centres_are_searched_faster_than_one_by_one():
    import time

    rng = np.random.default_rng(4)
    centres, points = rng.standard_normal((5000, 64)), rng.standard_normal((1000, 64))
    squares = (centres * centres).sum(axis=1)
    cluster._nearest_blocked(points[:10], centres, squares, 9)
    t0 = time.perf_counter()
    a, _ = cluster._nearest_blocked(points, centres, squares, 9)
    t1 = time.perf_counter()
    b, _ = cluster._exact_nearest(points, centres, 9)
    t2 = time.perf_counter()
    assert (a == b).all()
    assert t2 - t1 > 2 * (t1 - t0)  # 5 times and more on an idle core
