"""Shared scratch space."""

from __future__ import annotations

import os

from vitrail.session import cut_lineage, ensure_checkpoint_dir, remove_path, scratch_path


def test_scratch_paths_live_under_the_declared_folder(spark):
    root = ensure_checkpoint_dir(spark)
    warehouse = spark.conf.get("spark.sql.warehouse.dir")
    declared = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    assert root.replace("file:", "").startswith((declared or warehouse).replace("file:", ""))
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and a.startswith(root.rstrip("/"))


def test_scratch_is_removed(spark):
    path = scratch_path(spark, "gone")
    spark.range(10).write.parquet(path)
    local = path.replace("file:", "")
    assert os.path.isdir(local)
    remove_path(spark, path)
    assert not os.path.exists(local)


def test_lineage_is_cut_by_a_reliable_checkpoint(spark):
    df = cut_lineage(spark.range(100).where("id % 2 = 0"))
    assert df.count() == 50 and df.rdd.isCheckpointed
