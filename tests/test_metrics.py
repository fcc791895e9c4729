"""Metrics against a plain-Python recount on random label pairs."""

from __future__ import annotations

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from vitrail.operators import metrics

pairs = st.lists(st.tuples(st.integers(1, 7), st.integers(1, 7)), min_size=1, max_size=60)


def recount(rows):
    classes = sorted({l for l, _ in rows} | {p for _, p in rows})
    out = {}
    total = len(rows)
    correct = sum(1 for l, p in rows if l == p)
    for c in classes:
        tp = sum(1 for l, p in rows if l == c and p == c)
        fp = sum(1 for l, p in rows if p == c and l != c)
        fn = sum(1 for l, p in rows if l == c and p != c)
        prec = 0.0 if tp == 0 else tp / (tp + fp)
        rec = 0.0 if tp == 0 else tp / (tp + fn)
        f1 = 0.0 if prec + rec == 0 else 2 * prec * rec / (prec + rec)
        out[c] = (tp, fp, fn, total - tp - fp - fn, correct - tp, prec, rec, f1)
    return out


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(pairs)
def test_per_class_and_macro(spark, rows):
    df = spark.createDataFrame(rows, "label int, prediction int")
    ovr = metrics.one_vs_rest(metrics.confusion_matrix(df))
    pc = metrics.per_class_metrics(ovr)
    ref = recount(rows)
    o = {r["class"]: r for r in ovr.collect()}
    got = {r["class"]: r for r in pc.collect()}
    assert set(got) == set(ref)
    for c, (tp, fp, fn, tn, co, p, r, f) in ref.items():
        assert (o[c].tp, o[c].fp, o[c].fn, o[c].tn, o[c].correct_other) == (tp, fp, fn, tn, co)
        assert got[c].precision == pytest.approx(p) and got[c].recall == pytest.approx(r)
        assert got[c].f1 == pytest.approx(f)
    macro = metrics.macro_summary(pc, "m").collect()[0]
    mp = sum(v[5] for v in ref.values()) / len(ref)
    mr = sum(v[6] for v in ref.values()) / len(ref)
    assert macro.precision == pytest.approx(mp) and macro.recall == pytest.approx(mr)
    assert macro.f_measure == pytest.approx(0.0 if mp + mr == 0 else 2 * mp * mr / (mp + mr))


def test_macro_with_fixed_class_count(spark):
    rows = [(1, 1), (2, 2), (2, 1)]
    pc = metrics.per_class_metrics(metrics.one_vs_rest(
        metrics.confusion_matrix(spark.createDataFrame(rows, "label int, prediction int"))))
    fixed = metrics.macro_summary(pc, "x", n_classes=7).collect()[0]
    assert fixed.precision == pytest.approx((0.5 + 1.0) / 7)


def test_columns_by_name_not_position(spark):
    df = spark.createDataFrame([(1, 2), (1, 1)], "prediction int, label int")
    cm = {(r.label, r.prediction): r.n for r in metrics.confusion_matrix(df).collect()}
    assert cm == {(2, 1): 1, (1, 1): 1}


def test_accuracy_error(spark):
    df = spark.createDataFrame([(1, 1), (1, 2), (3, 3), (4, 3)], "label int, prediction int")
    r = metrics.accuracy(df).collect()[0]
    assert (r.n, r.n_correct, r.accuracy, r.error) == (4, 2, 0.5, 0.5)


sets = st.lists(st.tuples(st.sets(st.integers(0, 4), max_size=4), st.sets(st.integers(0, 4), min_size=1, max_size=4)),
                min_size=1, max_size=20)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(sets)
def test_multilabel_against_recount(spark, rows):
    data = [([float(x) for x in p], [float(x) for x in l]) for p, l in rows]
    df = spark.createDataFrame(data, "prediction array<double>, label array<double>")
    got = metrics.multilabel_metrics(df).collect()[0]
    n = len(rows)
    prec = sum(len(p & l) / len(p) if p else 0.0 for p, l in rows) / n
    rec = sum(len(p & l) / len(l) for p, l in rows) / n
    f1 = sum(2 * len(p & l) / (len(p) + len(l)) for p, l in rows) / n
    acc = sum(len(p & l) / len(p | l) for p, l in rows) / n
    assert (got.precision, got.recall, got.f1, got.accuracy) == pytest.approx((prec, rec, f1, acc))


def test_multilabel_agrees_with_spark_evaluator(spark):
    from pyspark.ml.evaluation import MultilabelClassificationEvaluator
    data = [([0.0, 1.0], [0.0, 2.0]), ([0.0, 2.0], [0.0, 1.0]), ([], [0.0]), ([2.0], [2.0]),
            ([2.0, 0.0], [2.0, 0.0]), ([0.0, 1.0, 2.0], [0.0, 1.0]), ([1.0], [1.0, 2.0])]
    df = spark.createDataFrame(data, "prediction array<double>, label array<double>")
    got = metrics.multilabel_metrics(df).collect()[0]
    for name, ours in (("precision", got.precision), ("recall", got.recall),
                       ("f1Measure", got.f1), ("accuracy", got.accuracy)):
        ev = MultilabelClassificationEvaluator(metricName=name)
        assert ev.evaluate(df) == pytest.approx(ours)


def test_mixed_label_and_prediction_types(spark):
    df = spark.createDataFrame([(1, 1.0), (2, 1.0), (2, 2.0)], "label int, prediction double")
    o = {r["class"]: r for r in metrics.one_vs_rest(metrics.confusion_matrix(df)).collect()}
    assert (o[1].tp, o[1].fp, o[2].tp, o[2].fn) == (1, 1, 1, 1)


def test_summarize_equals_the_chain(spark):
    df = spark.createDataFrame([(1, 1), (1, 2), (2, 2), (3, 2)], "label int, prediction int")
    chain = metrics.macro_summary(metrics.per_class_metrics(metrics.one_vs_rest(
        metrics.confusion_matrix(df))), "m", 7).first()
    assert metrics.summarize(df, "m", n_classes=7).first() == chain
