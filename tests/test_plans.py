"""Scale properties of the physical plans, checked on executed (final adaptive) plans."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from vitrail.operators import cluster, describe, metrics, split
from vitrail.plans import catalog
from vitrail.sources import delimited

from .conftest import SF01


def executed_plan(df) -> str:
    df.collect()
    jvm = df.sparkSession._jvm
    mode = jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    text = df._jdf.queryExecution().explainString(mode)
    return text


def test_hash_split_is_narrow(spark):
    li = spark.read.parquet(f"{SF01}/lineitem.parquet")
    plan = executed_plan(split.hash_split_tag(li.select("l_orderkey", "l_linenumber"),
                                              ["l_orderkey", "l_linenumber"]))
    assert "Exchange" not in plan


def test_nearest_centre_needs_no_shuffle_or_pair_join(spark):
    emb = spark.read.parquet(f"{SF01}/embeddings.parquet")
    out = cluster.assign_nearest(emb, "embedding", [[0.0] * 64, [0.1] * 64])
    plan = executed_plan(out.select("vec_id", "cluster", "distance"))
    assert "Exchange" not in plan
    assert "NestedLoopJoin" not in plan and "CartesianProduct" not in plan


def test_class_share_total_reuses_the_grouping_shuffle(spark):
    li = spark.read.parquet(f"{SF01}/lineitem.parquet")
    scored = li.select(F.col("l_linenumber").alias("label"))
    plan = executed_plan(describe.class_distribution(scored, "label"))
    assert "ReusedExchange" in plan


def test_one_vs_rest_scans_once(spark):
    plan = executed_plan(metrics.one_vs_rest(metrics.confusion_matrix(
        catalog.rule_scored(spark, SF01))))
    # both totals come from one merged subquery that reads the confusion shuffle again
    assert "ReusedExchange" in plan and "ReusedSubquery" in plan


def test_each_line_is_parsed_once(spark):
    lines = catalog.lineitem_lines(spark, SF01)
    parsed = delimited.parse_lines(lines, ";")
    df = delimited.good_rows(parsed)
    df.collect()
    jvm = df.sparkSession._jvm
    simple = df._jdf.queryExecution().explainString(
        jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple"))
    final = simple.split("== Initial Plan ==")[0]
    parse_lines = [ln for ln in final.splitlines() if "from_csv(" in ln]
    # one parse per line: the only operator evaluating from_csv is the generate, and it
    # keeps every field (the corrupt-record column included), so nothing re-parses per
    # column or prunes the parse
    assert len(parse_lines) == 1 and "Generate" in parse_lines[0]
    assert "_corrupt" in parse_lines[0]
    # no filter slips below the parse (it would re-evaluate the rendered line)
    assert not re.search(r"\bFilter\s", final.split("Generate", 1)[1])


def test_scans_read_only_needed_columns_and_push_filters(spark):
    plan = executed_plan(catalog.q_col_stats(spark, SF01))
    assert "ReadSchema: struct<l_quantity:double,l_extendedprice:double,l_discount:double,l_tax:double>" in plan
    li = spark.read.parquet(f"{SF01}/lineitem.parquet")
    plan = executed_plan(li.where(F.col("l_returnflag").isin("A", "R")).select("l_discount"))
    assert "PushedFilters: [In(l_returnflag, [A,R])" in plan
