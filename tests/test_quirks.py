"""One case per quirk of the original notebook: what vitrail does."""

from __future__ import annotations

import math

import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator

from vitrail.operators import cluster, describe, metrics, models, split
from vitrail.sources import delimited


def _write(tmp_path, text, name="f.csv"):
    p = tmp_path / name
    p.write_text(text, encoding="utf-8")
    return str(p)


def test_q1_malformed_counted_before_filter(spark, tmp_path):
    prof = delimited.load_profile(spark, _write(tmp_path, "a;b\n1;2\n3\n4;5;6\n"), ";").first()
    assert (prof.n_rows, prof.n_malformed) == (1, 2)


def test_q2_every_header_repeat_dropped(spark, tmp_path):
    df = delimited.load_table(spark, _write(tmp_path, "a;b\n1;2\na;b\n3;4\na;b\n"), ";")
    assert df.count() == 2


def test_q3_f_measure_is_harmonic(spark):
    df = spark.createDataFrame([(1, 1), (1, 2), (2, 2), (2, 2)], "label int, prediction int")
    pc = metrics.per_class_metrics(metrics.one_vs_rest(metrics.confusion_matrix(df)))
    m = metrics.macro_summary(pc, "x").first()
    assert m.f_measure == pytest.approx(2 * m.precision * m.recall / (m.precision + m.recall))


def test_q4_classes_present_by_default_fixed_on_request(spark):
    df = spark.createDataFrame([(1, 1), (2, 2)], "label int, prediction int")
    pc = metrics.per_class_metrics(metrics.one_vs_rest(metrics.confusion_matrix(df)))
    assert metrics.macro_summary(pc, "x").first().precision == 1.0
    assert metrics.macro_summary(pc, "x", n_classes=7).first().precision == pytest.approx(2 / 7)


def test_q5_columns_by_name(spark):
    a = spark.createDataFrame([(1, 2)], "label int, prediction int")
    b = spark.createDataFrame([(2, 1)], "prediction int, label int")
    ca = metrics.confusion_matrix(a).first()
    cb = metrics.confusion_matrix(b).first()
    assert (ca.label, ca.prediction) == (cb.label, cb.prediction) == (1, 2)


def test_q6_true_negatives_and_original_vn(spark):
    df = spark.createDataFrame([(1, 1), (2, 3), (3, 3)], "label int, prediction int")
    o = {r["class"]: r for r in metrics.one_vs_rest(metrics.confusion_matrix(df)).collect()}
    assert o[1].tn == 2 and o[1].correct_other == 1


def test_q7_both_distance_sums(spark):
    df = spark.createDataFrame([(0, [3.0, 4.0])], "id int, p array<double>")
    s = cluster.distance_sums(cluster.assign_nearest(df, "p", [[0.0, 0.0]])).first()
    assert (s.sum_distance, s.sum_sq_distance) == (5.0, 25.0)


def test_q8_explicit_feature_list_and_indexed_binary_labels(spark):
    rows = [(float(1 + i % 2), float(i % 2), 1.0, 99.0) for i in range(40)]
    df = spark.createDataFrame(rows, "label double, a double, b double, dropped double")
    clf = models.fit_classifier(df, models.linear_svm(), "label", ["a", "b"])
    assert clf.features == ["a", "b"]
    assert {r.prediction for r in clf.transform(df).collect()} <= {1.0, 2.0}


def test_q9_multilabel_takes_arrays(spark):
    df = spark.createDataFrame([([1.0], [1.0, 2.0])], "prediction array<double>, label array<double>")
    assert metrics.multilabel_metrics(df).first().recall == 0.5


def test_q11_precision_name_is_accuracy(spark):
    df = spark.createDataFrame([(1.0, 1.0), (0.0, 1.0)], "prediction double, label double")
    acc = MulticlassClassificationEvaluator(metricName="accuracy").evaluate(df)
    assert acc == metrics.accuracy(df).first().accuracy == 0.5


def test_q12_runs_are_seed_restarts(spark):
    rows = [(float(i % 2) * 10 + 0.1 * (i % 5), 0.0) for i in range(40)]
    df = cluster.to_vector(spark.createDataFrame([([a, b],) for a, b in rows], "p array<double>"), "p")
    _, best = cluster.kmeans_best_of(df, k=2, runs=3)
    for seed in range(3):
        _, single = cluster.kmeans_best_of(df, k=2, runs=1, base_seed=seed)
        assert best <= single + 1e-9


def test_q13_crosstab_sizes_from_parameters(spark):
    df = spark.createDataFrame([(0, 1), (1, 2)], "cluster int, label int")
    grid = cluster.crosstab(df, "cluster", "label", [1, 2, 3], clusters=[0, 1, 2])
    assert grid.columns == ["cluster", "label_1", "label_2", "label_3"] and grid.count() == 3


def test_q14_empty_fields_are_null(spark, tmp_path):
    r = delimited.load_table(spark, _write(tmp_path, 'a;b;c\n"";;x\n'), ";").first()
    assert (r.a, r.b, r.c) == (None, None, "x")


def test_q15_unknown_type_word_raises():
    with pytest.raises(ValueError):
        delimited.build_schema(["str", "float"], ["a", "b"])


def test_q16_accents_really_stripped(spark, tmp_path):
    r = delimited.load_table(spark, _write(tmp_path, "v\nçà et là\n"), ";").first()
    assert r.v == "ca et la"


def test_q17_seeds_required(spark):
    with pytest.raises(TypeError):
        split.random_split(spark.range(3), (0.5, 0.5))  # type: ignore[call-arg]
    with pytest.raises(TypeError):
        split.sample_rows(spark.range(3), 0.5)  # type: ignore[call-arg]


def test_q18_distribution_is_one_aggregate(spark):
    df = spark.createDataFrame([(c,) for c in "abcaab"], "t string")
    out = describe.class_distribution(df, "t")
    assert {r["class"]: r.n for r in out.collect()} == {"a": 3, "b": 2, "c": 1}


def test_q24_text_statistics_are_cast(spark):
    df = spark.createDataFrame([("1.5",), ("2.5",)], "v string")
    assert describe.column_stats(df, ["v"]).first().mean == 2.0


def test_q25_blank_line_is_malformed(spark, tmp_path):
    prof = delimited.load_profile(spark, _write(tmp_path, "a\n1\n\n2\n"), ";").first()
    assert (prof.n_rows, prof.n_malformed) == (2, 1)


def test_g12_one_based_labels_mapped_back(spark):
    rows = [(float(1 + i % 2), float(i % 2) * 4 + 1.0) for i in range(30)]
    df = spark.createDataFrame(rows, "label double, x double")
    clf = models.fit_classifier(df, models.naive_bayes(), "label", ["x"])
    preds = {r.prediction for r in clf.transform(df).collect()}
    assert preds <= {1.0, 2.0} and not math.isnan(next(iter(preds)))
