"""Profiling: distribution, statistics, correlation, exact distributed quantiles."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from vitrail.operators import describe
from vitrail.operators.quantiles import approx_quantiles, exact_quantiles


def test_class_distribution_any_number_of_classes(spark):
    rows = [(c,) for c, n in zip("abcdefgh", [70, 76, 17, 13, 9, 29, 1, 2]) for _ in range(n)]
    df = spark.createDataFrame(rows, "t string")
    got = {r["class"]: (r.n, r.share) for r in describe.class_distribution(df, "t").collect()}
    assert len(got) == 8 and got["b"][0] == 76
    assert sum(s for _, s in got.values()) == pytest.approx(1.0)
    assert got["a"][1] + got["b"][1] == pytest.approx(146 / 217)


def test_column_stats_casts_text_first(spark):
    df = spark.createDataFrame([("1.0", "0"), ("3.0", "2"), ("0", "4")], "a string, b string")
    st = {r.feature: r for r in describe.column_stats(df, ["a", "b"]).collect()}
    assert st["a"].mean == pytest.approx(4 / 3) and st["a"].num_nonzeros == 2
    assert st["b"].variance == pytest.approx(4.0) and st["b"].num_nonzeros == 2


def test_correlation_matrix_symmetric_with_unit_diagonal(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=300)
    data = [(float(a), float(2 * a + rng.normal()), float(rng.normal())) for a in x]
    df = spark.createDataFrame(data, "x double, y double, z double")
    m = {(r.i, r.j): r.corr for r in describe.correlation_matrix(df, ["x", "y", "z"]).collect()}
    arr = np.array([r for r in data])
    ref = np.corrcoef(arr.T)
    for (i, j), v in m.items():
        assert v == pytest.approx(ref[i, j], abs=1e-12)
        assert v == m[(j, i)]


@pytest.mark.parametrize("seed", [1, 3, 8])
def test_exact_quantiles_match_linear_interpolation(spark, seed):
    rng = np.random.default_rng(seed)
    n = 1001
    skewed = np.where(rng.random(n) < 0.34, 0.0, rng.normal(size=n))  # a third are zeros
    ints = rng.integers(0, 5, size=n).astype(float)
    wild = np.exp(rng.normal(size=n) * 60) * rng.choice([-1, 1], size=n)  # 50 decades
    data = [(float(a), float(b), float(c)) for a, b, c in zip(skewed, ints, wild)]
    df = spark.createDataFrame(data, "s double, k double, w double").repartition(5)
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]
    got = {(r.feature, r.prob): r.value
           for r in exact_quantiles(df, ["s", "k", "w"], probs).collect()}
    for name, col in (("s", skewed), ("k", ints), ("w", wild)):
        for p in probs:
            assert got[(name, p)] == pytest.approx(np.quantile(col, p, method="linear"),
                                                   rel=1e-12, abs=1e-12)


def test_exact_quantiles_ignore_nulls_and_empty_columns(spark):
    df = spark.createDataFrame([(1.0, None), (None, None), (3.0, None), (2.0, None)],
                               "v double, e double")
    got = {(r.feature, r.prob): r.value
           for r in exact_quantiles(df, ["v", "e"], [0.5, 0.25]).collect()}
    assert got == {("v", 0.5): 2.0, ("v", 0.25): 1.5}


def test_exact_quantiles_of_extremes(spark):
    inf, big = float("inf"), 1.7e308
    df = spark.createDataFrame([(-inf,), (-big,), (0.0,), (big,), (inf,), (float("nan"),)],
                               "v double")
    got = {r.prob: r.value for r in exact_quantiles(df, ["v"], [0, 0.2, 0.4, 0.6, 0.8, 1]).collect()}
    assert [got[p] for p in (0, 0.2, 0.4, 0.6, 0.8)] == [-inf, -big, 0.0, big, inf]
    assert got[1.0] != got[1.0]


def test_describe_numeric_exact_and_approx(spark):
    data = [(float(i), float(i % 7)) for i in range(1, 101)]
    df = spark.createDataFrame(data, "a double, b double")
    exact = {r.feature: r for r in describe.describe_numeric(df, ["a", "b"]).collect()}
    assert exact["a"].q25 == pytest.approx(25.75) and exact["a"].q50 == pytest.approx(50.5)
    assert exact["a"]["count"] == 100 and exact["a"].min == 1.0 and exact["a"].max == 100.0
    assert exact["a"].std == pytest.approx(np.std(np.arange(1, 101), ddof=1))
    approx = {(r.feature, r.prob): r.value for r in approx_quantiles(df, ["a"], [0.5]).collect()}
    assert abs(approx[("a", 0.5)] - 50.5) <= 1.0


def test_quantile_labels_are_distinct(spark):
    df = spark.createDataFrame([(float(i),) for i in range(1001)], "v double")
    row = describe.describe_numeric(df, ["v"], probs=(0.5, 0.999, 1.0)).first()
    assert (row.q50, row.q99_9, row.q100) == (500.0, pytest.approx(999.0), 1000.0)


def test_pairwise_correlation_with_gaps(spark):
    rng = random.Random(8)
    rows = [tuple(None if rng.random() < 0.3 else v for v in (
        i + rng.random(), 1e9 + rng.random(), i * 2.0 + rng.gauss(0, 50), 7.0))
        for i in range(400)]
    rows += [(math.nan, 1.0, None, None), (math.inf, 2.0, 3.0, None)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double").repartition(7)
    x = np.array([[math.nan if v is None else v for v in r] for r in rows])
    got = {(r.i, r.j): r for r in describe.pairwise_correlation(
        df, ["a", "b", "c", "d"]).collect()}
    assert len(got) == 16
    for (i, j), r in got.items():
        both = np.isfinite(x[:, i]) & np.isfinite(x[:, j])
        assert r.n == both.sum()
        if 3 in (i, j):
            assert r["corr"] is None  # constant
        else:
            y = x[both] - np.nanmean(np.where(np.isfinite(x), x, np.nan), axis=0)
            assert r["corr"] == pytest.approx(np.corrcoef(y[:, i], y[:, j])[0, 1], abs=1e-9)


def test_pairwise_correlation_of_many_columns_and_none(spark):
    d = 40
    df = spark.range(200).select(*[((F.col("id") * (i + 3)) % 101).cast("double").alias(f"c{i}")
                                   for i in range(d)])
    got = describe.pairwise_correlation(df, df.columns).collect()
    want = {(r.i, r.j): r["corr"] for r in describe.correlation_matrix(df, df.columns).collect()}
    assert len(got) == d * d
    assert all(r["corr"] == pytest.approx(want[r.i, r.j], abs=1e-9) for r in got)
    empty = describe.pairwise_correlation(df.limit(0), ["c0", "c1"]).collect()
    assert all(r.n == 0 and r["corr"] is None for r in empty)
