"""Evaluation.

Everything starts from one ``groupBy(label, prediction).count()`` -- a table of at most
classes^2 rows -- instead of four filtered counts per class over the scored data.  The
per-class and macro tables are then computed on that small table with ordinary
aggregates; totals are scalar subqueries.  Columns are found by name, so swapped
(label, prediction) orders cannot swap precision and recall.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def comparable(df: DataFrame, label: str, prediction: str) -> tuple[Column, Column]:
    """Label and prediction in one type, so that every metric calls the same rows correct:
    as they are when the types agree, numbers as doubles, anything else as text."""
    kinds = [df.schema[c].dataType for c in (label, prediction)]
    if kinds[0] == kinds[1]:
        return F.col(label), F.col(prediction)
    both = "double" if all(isinstance(k, T.NumericType) for k in kinds) else "string"
    return F.col(label).cast(both), F.col(prediction).cast(both)


def _ratio(num: Column, den: Column) -> Column:
    """num / den, 0 when the numerator is 0 (the original guard) or the denominator is."""
    return F.when((num == 0) | (den == 0), F.lit(0.0)).otherwise(num.cast("double") / den)


def confusion_matrix(scored: DataFrame, label: str = "label",
                     prediction: str = "prediction") -> DataFrame:
    """D12 base: ``(label, prediction, n)`` for every pair that occurs."""
    return (scored.groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction"))
                  .agg(F.count(F.lit(1)).alias("n")))


def one_vs_rest(confusion: DataFrame) -> DataFrame:
    """Per class ``tp, fp, fn, tn`` (true one-vs-rest) and ``correct_other`` -- the
    original's "VN", which only counts correct predictions of the other classes.

    Classes are those present as a label or as a prediction."""
    lab, pred = comparable(confusion, "label", "prediction")
    hit = lab == pred
    n = F.col("n")
    zero = F.lit(0).cast("bigint")
    contributions = F.array(
        F.struct(lab.alias("class"),
                 F.when(hit, n).otherwise(zero).alias("tp"),
                 zero.alias("fp"),
                 F.when(hit, zero).otherwise(n).alias("fn")),
        F.struct(pred.alias("class"), zero.alias("tp"),
                 F.when(hit, zero).otherwise(n).alias("fp"), zero.alias("fn")),
    )
    per_class = (confusion.select(F.explode(contributions).alias("c")).select("c.*")
                 .groupBy("class")
                 .agg(F.sum("tp").alias("tp"), F.sum("fp").alias("fp"), F.sum("fn").alias("fn")))
    total = confusion.select(F.sum("n")).scalar()
    correct = confusion.select(F.sum(F.when(hit, n).otherwise(zero))).scalar()
    return per_class.select(
        "class", "tp", "fp", "fn",
        (total - F.col("tp") - F.col("fp") - F.col("fn")).alias("tn"),
        (correct - F.col("tp")).alias("correct_other"))


def per_class_metrics(ovr: DataFrame) -> DataFrame:
    """I3 + I4 + F1 per class; precision and recall are 0 when tp is 0, F1 is the
    harmonic mean (0 when both are 0)."""
    p = _ratio(F.col("tp"), F.col("tp") + F.col("fp"))
    r = _ratio(F.col("tp"), F.col("tp") + F.col("fn"))
    out = ovr.select("class", "tp", "fp", "fn", p.alias("precision"), r.alias("recall"))
    return out.withColumn("f1", _harmonic(F.col("precision"), F.col("recall")))


def _harmonic(p: Column, r: Column) -> Column:
    return F.when(p + r == 0, F.lit(0.0)).otherwise(2.0 * p * r / (p + r))


def macro_summary(per_class: DataFrame, method: str,
                  n_classes: int | None = None) -> DataFrame:
    """``(method, precision, recall, f_measure)`` -- mean precision and recall over the
    classes, and the harmonic mean of the two means.

    ``n_classes=None`` divides by the number of classes present; an explicit value
    reproduces a fixed class count (absent classes then score 0)."""
    den = F.count(F.lit(1)) if n_classes is None else F.lit(float(n_classes))
    means = per_class.agg((F.sum("precision") / den).alias("precision"),
                          (F.sum("recall") / den).alias("recall"))
    return means.select(F.lit(method).alias("method"), "precision", "recall",
                        _harmonic(F.col("precision"), F.col("recall")).alias("f_measure"))


def accuracy(scored: DataFrame, label: str = "label",
             prediction: str = "prediction") -> DataFrame:
    """I1 + I2 + G11: ``(n, n_correct, accuracy, error)`` in one aggregate."""
    lab, pred = comparable(scored, label, prediction)
    hit = lab == pred
    agg = scored.agg(F.count(F.lit(1)).alias("n"), F.count_if(hit).alias("n_correct"))
    acc = F.when(F.col("n") == 0, F.lit(None).cast("double")).otherwise(
        F.col("n_correct") / F.col("n"))
    return agg.select("n", "n_correct", acc.alias("accuracy"), (1.0 - acc).alias("error"))


def multilabel_metrics(scored: DataFrame, label: str = "label",
                       prediction: str = "prediction") -> DataFrame:
    """I8: example-based multilabel precision, recall, F1 and accuracy (subset Jaccard),
    one aggregate over per-row set sizes.  Empty sets contribute 0 to a ratio."""
    p, lab = F.array_distinct(F.col(prediction)), F.array_distinct(F.col(label))
    inter = F.size(F.array_intersect(p, lab))
    union = F.size(F.array_union(p, lab))
    row = scored.select(inter.alias("i"), union.alias("u"), F.size(p).alias("np"),
                        F.size(lab).alias("nl"))
    return row.agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(_ratio(F.col("i"), F.col("np"))).alias("precision"),
        F.avg(_ratio(F.col("i"), F.col("nl"))).alias("recall"),
        F.avg(_ratio(2 * F.col("i"), F.col("np") + F.col("nl"))).alias("f1"),
        F.avg(_ratio(F.col("i"), F.col("u"))).alias("accuracy"),
    )


def summarize(scored: DataFrame, method: str, label: str = "label",
              prediction: str = "prediction", n_classes: int | None = None) -> DataFrame:
    """I6 in one call: confusion -> one-vs-rest -> per-class -> macro summary row."""
    per_class = per_class_metrics(one_vs_rest(confusion_matrix(scored, label, prediction)))
    return macro_summary(per_class, method, n_classes)
