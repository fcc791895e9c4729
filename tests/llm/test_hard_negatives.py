from __future__ import annotations

import math

import numpy as np
import pytest

from vitrail.llm import hard_negatives
from vitrail.llm.common import table
from vitrail.llm.hard_negatives import Mining
from vitrail.plans.compare import compare, duck_connection

from ..conftest import SF01


def brute(rows, m, every=100):
    """(anchor, positive, rank, negative, scores) from whole Python integers."""
    v = [(i, label, [math.floor(m.scale * x) for x in vec]) for i, label, vec in rows]
    out = []
    for a, label, x in v:
        if a % every:
            continue
        scores = [(sum(p * q for p, q in zip(x, y)), i, other) for i, other, y in v
                  if i != a and len(y) == len(x)]
        order = sorted(scores, key=lambda s: (-s[0], s[1]))
        for ps, p, _ in [s for s in order if s[2] == label][:m.positives]:
            band = [s for s in order if s[2] != label
                    and m.low * ps <= 100 * s[0] <= m.high * ps][:m.negatives]
            out += [(a, p, r + 1, s[1], ps, s[0]) for r, s in enumerate(band)]
    return sorted(out)


def mined(df, m=Mining(), every=100):
    return sorted(map(tuple, hard_negatives.mine(df, lambda i: i % every == 0, m).collect()))


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_query_equals_sql(spark, sf):
    path = f"/root/testdata/{sf}"
    got = hard_negatives.op11_hard_negatives(spark, path)
    rel = duck_connection(path).sql(hard_negatives.OP11_SQL)
    assert compare(got.columns, [tuple(r) for r in got.collect()], rel.columns,
                   rel.fetchall()) is None


@pytest.mark.parametrize("d", [1, 3, 33, 64])
def test_ties_bands_and_odd_dimensions(spark, d):
    rng = np.random.default_rng(d)
    rows = [(i, int(rng.integers(0, 3)), (rng.integers(-3, 4, d) / 4).tolist())
            for i in range(400)]
    assert mined(frame(spark, rows), every=40) == brute(rows, Mining(), 40)


def test_blocks_change_nothing_and_a_hot_label(spark):
    rng = np.random.default_rng(9)
    centres = rng.standard_normal((4, 16))
    rows = [(i, int(k), (centres[k] + 0.2 * rng.standard_normal(16)).tolist())
            for i, k in enumerate(rng.choice(4, 500, p=[0.7, 0.1, 0.1, 0.1]))]
    df = frame(spark, rows)
    want = brute(rows, Mining(), 20)
    assert want and mined(df, every=20) == want
    assert mined(df, Mining(rows=37, anchors=5, segments=4), every=20) == want


def test_scores_beyond_doubles_are_exact(spark):
    rng = np.random.default_rng(4)
    rows = [(i, i % 2, [float(x) for x in rng.integers(-2**20, 2**20, 8)]) for i in range(200)]
    assert mined(frame(spark, rows), every=20) == brute(rows, Mining(), 20)


def test_rows_that_take_no_part(spark):
    inf, nan = math.inf, math.nan
    good = [(0, 1, [1.0, 0.0]), (1, 1, [1.0, 0.0]), (2, 2, [0.5, 0.0]), (3, 2, [0.5, 9.0]),
            (100, 1, [0.0, 1.0, 0.0]), (101, 1, [0.0, 2.0, 0.0]), (102, 3, [0.0, 1.0, 7.0]),
            (200, 5, []), (201, 5, []), (202, 6, [])]
    bad = [(4, None, [1.0, 0.0]), (5, 2, None), (6, 2, [None, 1.0]), (7, 2, [nan, 1.0]),
           (8, 2, [inf, 0.5]), (None, 2, [0.5, 0.0]), (300, 1, [1e300, 1.0]), (9, 2, [3e9, 0.0])]
    df = frame(spark, good + bad + [good[2], (2, 7, [0.6, 0.0])])
    assert mined(df) == brute(good, Mining())


def test_empty_tables_and_extra_columns(spark):
    df = frame(spark, [(0, 1, [1.0]), (1, 1, [1.0]), (2, 2, [0.5])])
    assert mined(df.limit(0)) == []
    assert mined(df.where("vec_id > 0")) == []
    clash = df.selectExpr("*", "1 as score", "2 as d", "'x' as sums", "3 as rank")
    assert mined(clash) == [(0, 1, 1, 2, 65536, 32768)]


def test_bounds_hold_and_tighten():
    rng = np.random.default_rng(2)
    x = rng.integers(-100, 100, (60, 24))
    m = Mining(segments=8)
    side = hard_negatives.Side(np.arange(60), np.zeros(60), x, hard_negatives.segment_sums(
        x, 8), hard_negatives.segment_sums(x * x, 8))
    exact, last = x @ x.T, None
    for level in range(len(side.levels)):
        low, high = hard_negatives.bounds(side, slice(0, 60), side, level)
        assert (low <= exact).all() and (exact <= high).all()
        assert last is None or (high - low <= last + 1e-6).all()
        last = high - low
    assert len(side.levels) == 4 and m.segments == 8
