from __future__ import annotations

import math

import numpy as np
import pytest

from vitrail.llm import ann
from vitrail.llm.common import table


def brute(rows, k=20):
    """Exact lists by (id, vector) rows, queries being ids divisible by 20."""
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], dtype=float)
    out = {}
    for q in np.flatnonzero(ids % 20 == 0):
        s = x @ x[q]
        others = np.flatnonzero(ids != ids[q])
        order = sorted(others, key=lambda j: (-round(s[j], 12), ids[j]))[:k]
        out[int(ids[q])] = [int(ids[j]) for j in order]
    return out


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_recall_and_scores(spark, sf):
    path = f"/root/testdata/{sf}"
    rows = [(r.vec_id, r.embedding) for r in table(spark, path, "embeddings").collect()]
    vectors = {i: np.array(v, dtype=float) for i, v in rows}
    want, got = brute(rows), {}
    for r in ann.op10_ann_forest(spark, path).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r)
        assert r.score == pytest.approx(float(vectors[r.query_id] @ vectors[r.vec_id]), abs=1e-14)
        assert r.vec_id != r.query_id
    assert set(got) == set(want)
    hits = sum(len(set(want[q]) & {r.vec_id for r in found}) for q, found in got.items())
    assert hits / sum(map(len, want.values())) >= 0.9
    for found in got.values():
        assert [r.rank for r in found] == list(range(1, 21))
        assert [(-r.score, r.vec_id) for r in found] == sorted((-r.score, r.vec_id) for r in found)


def test_equal_vectors_and_unusable_rows(spark):
    inf, nan = math.inf, math.nan
    rows = [(i, [1.0, 0.0]) for i in range(0, 60)] + [
        (100, [0.0, 2.0]), (101, [0.0, 1.0]), (102, None), (103, [0.0, 0.0]), (104, [nan, 1.0]),
        (105, [1.0, inf]), (106, [None, 1.0]), (107, [1.0]), (108, []), (None, [1.0, 1.0]),
        (101, [0.0, 1.0]), (120, None)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {}
    for r in ann.nearest(df, lambda i: i % 20 == 0, 20).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert set(got) == {0, 20, 40, 100}
    assert got[0] == [(i, 1.0) for i in range(1, 21)]
    assert got[20] == [(i, 1.0) for i in [*range(20)]] + [(21, 1.0)] or got[20] == [
        (i, 1.0) for i in range(20)]
    assert got[40] == [(i, 1.0) for i in range(20)]
    assert got[100][0] == (101, 2.0) and got[100][1:] == [(i, 0.0) for i in range(19)]


def test_few_and_no_rows(spark):
    kind = "vec_id long, embedding array<float>"
    one = spark.createDataFrame([(0, [1.0, 2.0]), (1, [3.0, -1.0])], kind)
    assert [tuple(r) for r in ann.nearest(one, lambda i: i % 20 == 0).collect()] == [(0, 1, 1, 1.0)]
    assert ann.nearest(one.limit(0), lambda i: i % 20 == 0).count() == 0
    assert ann.nearest(one.where("vec_id = 0"), lambda i: i % 20 == 0).count() == 0


def test_blocks_change_nothing(spark):
    rng = np.random.default_rng(1)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.standard_normal((300, 8)))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    lists = []
    for rows_, queries in ((8192, 4096), (7, 3)):
        s = ann.Settings(trees=2, leaves=4, visited=1.0, candidates=1e9, rows=rows_,
                         queries=queries)
        out = ann.nearest(df, lambda i: i % 20 == 0, 10, s).orderBy("query_id", "rank")
        lists.append([(r.query_id, r.rank, r.vec_id) for r in out.collect()])
    assert lists[0] == lists[1]
    want = brute(rows, 10)
    assert [v for _, _, v in lists[0]] == [j for q in sorted(want) for j in want[q]]


@pytest.mark.parametrize("candidates", [1e9, 12.0])
def test_ties_go_to_the_smaller_id_whatever_is_scored(spark, candidates):
    # integer vectors: most scores stand many times, far beyond the length of a list
    rng = np.random.default_rng(3)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.integers(-2, 3, (1500, 6)).astype(float))
            if v.any()]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    s = ann.Settings(candidates=candidates)
    got = {}
    for r in ann.nearest(df, lambda i: i % 20 == 0, 20, s).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    want = brute(rows)
    vectors = dict(rows)
    if candidates > 1e6:
        assert {q: [i for i, _ in f] for q, f in got.items()} == want
    for q, found in got.items():
        assert found == sorted(found, key=lambda f: (-f[1], f[0]))
        assert all(s == float(np.dot(vectors[q], vectors[i])) for i, s in found)
    # whoever is scored at all is listed in that order: at the last score no smaller id is left
    hits = sum(len(set(want[q]) & {i for i, _ in f}) for q, f in got.items())
    assert hits / sum(map(len, want.values())) >= 0.9


def test_a_hot_vector_asks_once(spark):
    rows = [(i, [1.0, 0.0, 0.5]) for i in range(400)] + [
        (1000 + i, [math.cos(i), math.sin(i), 0.1]) for i in range(300)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = {}
    for r in ann.nearest(df, lambda i: i % 20 == 0, 20).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    for q in range(0, 400, 20):
        assert got[q] == [i for i in range(22) if i != q][:20]
    assert set(got) == {i for i, _ in rows if i % 20 == 0}


def test_the_scored_share_falls_as_the_table_grows():
    rng = np.random.default_rng(5)
    shares, recalls = [], []
    for n in (1000, 4000, 16000):
        x = rng.standard_normal((n, 24))
        s = ann.Settings()
        forest = ann.grow(x[:s.sample], float(np.linalg.norm(x, axis=1).max()), s)
        leaves = forest.leaves(x)
        q = x[:40]
        sums = ann.sums_of_worth(forest.worth(q, s.visited), leaves)
        rank = int(s.candidates * n ** 0.5)
        line = -np.partition(-sums, rank, axis=1)[:, rank]
        passed = sums >= line[:, None]
        best = np.argsort(-(q @ x.T), axis=1)[:, :21]
        shares.append(passed.mean())
        recalls.append(np.take_along_axis(passed, best, axis=1).mean())
    assert shares[0] > 1.7 * shares[1] > 2.8 * shares[2] and min(recalls) >= 0.9
