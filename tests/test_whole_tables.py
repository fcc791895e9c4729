"""Registered row-level queries cover their whole source tables (no subsets, no caps)."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry

from .conftest import SF001

QUERIES = entry.queries()


def rows(spark, table):
    return spark.read.parquet(f"{SF001}/{table}.parquet").count()


@pytest.mark.parametrize("name, table", [
    ("hash_split", "lineitem"), ("parse_points", "lineitem"), ("ingest_file", "lineitem"),
    ("libsvm_roundtrip", "lineitem"), ("parse_points_semicolon", "lineitem"),
    ("strip_accents", "documents"), ("index_label", "events"),
    ("assign_nearest_centroid", "embeddings"),
])
def test_row_level_query_covers_its_table(spark, name, table):
    assert QUERIES[name](spark, SF001).count() == rows(spark, table)


def test_ingest_accounts_for_every_rendered_line(spark):
    good = QUERIES["ingest_delimited"](spark, SF001).count()
    bad = QUERIES["ingest_malformed"](spark, SF001).count()
    assert good + bad == rows(spark, "lineitem") + 1  # plus the blank line


def test_splits_partition_the_table(spark):
    total = rows(spark, "lineitem")
    scored = QUERIES["dt_classify"](spark, SF001).groupBy().sum("n").first()[0]  # 40% test split
    tagged = QUERIES["hash_split"](spark, SF001)
    assert scored == tagged.filter("split = 1").count() and 0 < scored < total


@pytest.mark.parametrize("name, table", [
    ("random_split", "lineitem"), ("sample_rows", "lineitem"), ("dt_stump", "lineitem"),
    ("svm_linear", "lineitem"), ("model_roundtrip", "lineitem"), ("rf_one_tree", "lineitem"),
    ("gmm_fit", "lineitem"), ("kmeans_fit", "embeddings"),
])
def test_counts_cover_the_table(spark, name, table):
    assert QUERIES[name](spark, SF001).groupBy().sum("n").first()[0] == rows(spark, table)


def test_aggregates_count_every_row(spark):
    cm = QUERIES["confusion_matrix"](spark, SF001)
    assert cm.groupBy().sum("n").first()[0] == rows(spark, "lineitem")
    cl = QUERIES["cluster_label_counts"](spark, SF001)
    assert cl.groupBy().sum("n").first()[0] == rows(spark, "embeddings")
