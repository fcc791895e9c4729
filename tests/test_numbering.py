"""Row numbers, running sums and positional pairing."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from vitrail.operators import numbering
from vitrail.plans import catalog

from .conftest import SF001


def test_numbers_by_order_are_gapless(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("v")).repartition(13)
    rows = numbering.number_rows(df, ["v"], "n").collect()
    assert all(r.n == r.v for r in rows) and len(rows) == 1000


def test_numbers_by_place_follow_partitions(spark):
    df = spark.range(0, 100, 1, 7).where("id % 10 <> 3")  # parts of different size
    got = [(r.n, r.id) for r in numbering.number_rows(df, col="n").orderBy("n").collect()]
    assert got == list(enumerate(i for i in range(100) if i % 10 != 3))


def test_numbering_an_empty_frame(spark):
    assert numbering.number_rows(spark.range(0)).count() == 0


@pytest.mark.parametrize("partitions", [1, 9])
def test_running_sums_by_group(spark, partitions):
    rnd = random.Random(5)
    rows = [(rnd.choice(["hot"] * 8 + ["a", "b", None]), i, rnd.randint(0, 9)) for i in range(900)]
    rows += [("one", 5, None)]
    df = spark.createDataFrame(rows, "g string, k long, v long").repartition(partitions)
    got = {(r.g, r.k): (r.before, r.n) for r in numbering.running_sums(
        df, ["k"], {"before": F.col("v"), "n": F.lit(1)}, ["g"]).collect()}
    want, total, count = {}, {}, {}
    for g, k, v in sorted(rows, key=lambda r: r[1]):
        want[g, k] = total.get(g, 0), count.get(g, 0)
        total[g] = total.get(g, 0) + (v or 0)
        count[g] = count.get(g, 0) + 1
    assert got == want


def test_running_sums_without_groups_and_of_nothing(spark):
    df = spark.range(50)
    got = {r.id: r.s for r in numbering.running_sums(df, ["id"], {"s": F.col("id")}).collect()}
    assert got == {i: i * (i - 1) // 2 for i in range(50)}
    assert numbering.running_sums(df.limit(0), ["id"], {"s": F.col("id")}).count() == 0


def test_pairs_by_position(spark):
    left = spark.range(0, 60, 1, 4).withColumnRenamed("id", "a")
    right = spark.range(0, 60, 1, 7).select((F.col("id") + 100).alias("b"))
    assert sorted((r.a, r.b) for r in numbering.pair_rows(left, right).collect()) == [
        (i, i + 100) for i in range(60)]


def test_pairing_raises_on_length_and_names(spark):
    left, right = spark.range(5).toDF("a"), spark.range(6).toDF("b")
    with pytest.raises(ValueError, match="5 and 6"):
        numbering.pair_rows(left, right)
    with pytest.raises(ValueError, match="both frames"):
        numbering.pair_rows(left, right.toDF("A"))


def test_files_pair_line_by_line(spark, workdir):
    # files whose sizes run against the order of their names, cut into many splits
    lines = [f"{i}" for i in range(3000)]
    for name, cuts in (("x", (10, 500, 3000)), ("y", (2000, 2010, 3000))):
        (workdir / name).mkdir()
        start = 0
        for i, end in enumerate(cuts):
            (workdir / name / f"part-{i}.txt").write_text("\n".join(lines[start:end]) + "\n")
            start = end
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2k")
    try:
        x, y = (numbering.file_order(spark.read.text(str(workdir / n))).toDF(n) for n in "xy")
        paired = numbering.pair_rows(x, y)
        assert paired.count() == 3000 and paired.where("x <> y").count() == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_parts_grow_in_number(spark, monkeypatch):
    """5 and 3 files, and as many parts as the session shuffles to, held tables of any size."""
    assert numbering.parts_for(10, 3) == 3
    assert numbering.parts_for(50 * numbering.PART_ROWS + 1, 3) == 51
    monkeypatch.setattr(numbering, "PART_ROWS", 100)
    monkeypatch.setattr(catalog, "remove_path", lambda spark, path: None)
    paths = []
    monkeypatch.setattr(catalog, "scratch_path", lambda spark, name, new=catalog.scratch_path: (
        paths.append(new(spark, name)) or paths[-1]))
    n = spark.read.parquet(f"{SF001}/lineitem.parquet").count()
    assert catalog.q_zip_predictions(spark, SF001).groupBy().sum("n").first()[0] == n
    files = [len(spark.read.text(p).inputFiles()) for p in paths]
    assert files[0] > 0.5 * n / 100 and files[1] > 0.3 * n / 100 and files[0] != files[1]
    ordered = numbering.file_order(spark.read.text(paths[0]))
    assert ordered.rdd.getNumPartitions() > 0.5 * n / 100
