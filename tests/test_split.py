"""Splits and sampling: disjoint, complete, reproducible."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from vitrail.operators import split


@pytest.mark.parametrize("method", ["md5", "xxhash64"])
def test_hash_split_disjoint_complete_and_stable(spark, method):
    df = spark.range(5000).withColumnRenamed("id", "k")
    a = split.hash_split_tag(df, ["k"], (0.6, 0.4), method=method).repartition(7)
    b = split.hash_split_tag(df.repartition(3), ["k"], (0.6, 0.4), method=method)
    ga = {r.k: r.split for r in a.collect()}
    gb = {r.k: r.split for r in b.collect()}
    assert ga == gb and len(ga) == 5000
    share = sum(1 for v in ga.values() if v == 0) / 5000
    assert 0.57 < share < 0.63
    train, test = split.hash_split(df, ["k"], (0.6, 0.4), method=method)
    assert train.count() + test.count() == 5000
    assert train.join(test, "k").count() == 0


def test_random_split_tag_complete(spark):
    df = spark.range(2000)
    tagged = split.random_split_tag(df, (0.7, 0.3), seed=1)
    counts = {r.split: r["count"] for r in tagged.groupBy("split").count().collect()}
    assert sum(counts.values()) == 2000 and 0.65 < counts[0] / 2000 < 0.75
    parts = split.random_split(df, (0.6, 0.4), seed=0)
    assert sum(p.count() for p in parts) == 2000


def test_sample_rows_bounds(spark):
    n = split.sample_rows(spark.range(10000), 0.1, seed=0).count()
    assert 850 < n < 1150
    with pytest.raises(ValueError):
        split.sample_rows(spark.range(10), 1.5, seed=0)


def test_weights_checked(spark):
    with pytest.raises(ValueError):
        split.hash_split_tag(spark.range(3), ["id"], (0.0, 0.0))


def hot_rows(spark, n=90_000):
    """A third of the rows are equal; the others come in pairs."""
    return spark.range(n).select(
        F.when(F.col("id") < n // 3, F.lit(-1)).otherwise(F.col("id") % (n // 3)).alias("k"),
        F.when(F.col("id") >= n // 3, "x").alias("s"))  # null where hot


def counted(df):
    return {tuple(r)[:-1]: r["count"] for r in df.groupBy(*df.columns).count().collect()}


def test_copies_of_a_hot_row_are_drawn_one_by_one(spark):
    df = hot_rows(spark)
    kept = counted(split.sample_rows(df, 0.1, seed=3))
    n, p = 30_000, 0.1
    assert abs(kept[(-1, None)] - n * p) <= 3 * (n * p * (1 - p)) ** 0.5
    rest = sum(v for k, v in kept.items() if k[0] != -1)
    assert abs(rest - 60_000 * p) <= 4 * (60_000 * p * (1 - p)) ** 0.5
    assert max(v for k, v in kept.items() if k[0] != -1) == 2  # both of some pairs
    assert 1 in kept.values()                                  # and one of others


def test_copies_are_drawn_alike_whatever_the_partitions(spark, monkeypatch):
    df = hot_rows(spark, 9_000)
    one = counted(split.sample_rows(df, 0.3, seed=4))
    assert one == counted(split.sample_rows(df.repartition(5), 0.3, seed=4))
    assert one != counted(split.sample_rows(df, 0.3, seed=5))
    monkeypatch.setattr(split, "RUN", 64)  # the hot row is dealt out in 47 runs
    assert one == counted(split.sample_rows(df.repartition(2), 0.3, seed=4))


def test_split_copies_partition_the_table(spark):
    df = hot_rows(spark, 9_000)
    parts = split.random_split(df, (0.5, 0.3, 0.2), seed=1)
    found = [counted(p) for p in parts]
    assert counted(df) == {k: sum(f.get(k, 0) for f in found) for k in counted(df)}
    shares = [f[(-1, None)] / 3000 for f in found]
    assert all(abs(a - b) < 0.03 for a, b in zip(shares, (0.5, 0.3, 0.2)))


def test_extreme_fractions_and_empty_tables(spark):
    df = hot_rows(spark, 90)
    assert split.sample_rows(df, 0.0, seed=0).count() == 0
    assert counted(split.sample_rows(df, 1.0, seed=0)) == counted(df)
    assert split.sample_rows(df.limit(0), 0.5, seed=0).count() == 0
    assert split.sample_rows(df, 0.5, seed=0).columns == df.columns


def test_keyed_draws_need_no_shuffle(spark):
    df = spark.range(100).withColumn("v", F.lit(1))
    plan = split.sample_rows(df, 0.5, seed=0, keys=["id"])._jdf.queryExecution().toString()
    assert "Exchange" not in plan
