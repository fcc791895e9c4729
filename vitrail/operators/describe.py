"""Profiling operators: class distribution, column statistics, correlation, describe
(B1, B2, D1-D8).  Each is one aggregation pass with map-side partial aggregates; wide
results are unpivoted from the single aggregate row, never computed per column."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.stat import Correlation
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrail.operators.quantiles import approx_quantiles, exact_quantiles


def class_distribution(df: DataFrame, label: str) -> DataFrame:
    """D1 + D2: ``(class, n, share)`` for every class present, any number of classes.

    The total is a scalar subquery over the *grouped* counts: Spark reuses the grouping
    shuffle for it (the input is scanned once), and the share needs neither a
    single-partition window nor a join."""
    grouped = df.groupBy(F.col(label).alias("class")).agg(F.count(F.lit(1)).alias("n"))
    total = grouped.select(F.sum("n")).scalar()
    return grouped.select("class", "n", (F.col("n") / total).alias("share"))


def _unpivot_row(row: DataFrame, cols: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """Single aggregate row with columns ``{field}_{i}`` -> one row per input column."""
    entries = [F.struct(F.lit(i).alias("idx"), F.lit(c).alias("feature"),
                        *[F.col(f"{f}_{i}").alias(f) for f in fields])
               for i, c in enumerate(cols)]
    return row.select(F.explode(F.array(*entries)).alias("e")).select("e.*")


def column_stats(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """D4-D6 (``colStats``): per column count, mean, sample variance, non-zeros, min, max.

    Columns are cast to double first (the original fed text to the statistics)."""
    aggs = []
    for i, c in enumerate(cols):
        x = F.col(c).cast("double")
        aggs += [F.count(x).alias(f"count_{i}"), F.avg(x).alias(f"mean_{i}"),
                 F.var_samp(x).alias(f"variance_{i}"),
                 F.count_if(x != 0).alias(f"num_nonzeros_{i}"),
                 F.min(x).alias(f"min_{i}"), F.max(x).alias(f"max_{i}")]
    return _unpivot_row(df.agg(*aggs), cols,
                        ["count", "mean", "variance", "num_nonzeros", "min", "max"]).orderBy("idx")


def correlation_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pearson matrix as ``(i, j, column_i, column_j, corr)``, all ordered pairs.

    One pass accumulates the Gram matrix of the assembled columns, whatever their number;
    rows with a NULL or NaN in any of them are left out.  columns x columns values reach
    the driver.  A constant column has no correlation (NaN), but 1 with itself."""
    numbers = df.select(*[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(cols)])
    rows = VectorAssembler(inputCols=numbers.columns, outputCol="x", handleInvalid="skip")
    matrix = Correlation.corr(rows.transform(numbers).select("x"), "x").first()[0].toArray()
    entries = [(i, j, a, b, float(matrix[i, j]))
               for i, a in enumerate(cols) for j, b in enumerate(cols)]
    return df.sparkSession.createDataFrame(
        entries, "i int, j int, column_i string, column_j string, corr double")


def pairwise_correlation(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """D7 with gaps: ``(i, j, column_i, column_j, n, corr)`` for all ordered pairs, each over
    the ``n`` rows that have both columns; NULL, NaN and infinite values are gaps.

    One pass: every task adds up masked Gram matrices (presence, values, squares, products)
    of its Arrow batches and hands on one row per column; they are added after one small
    shuffle of columns x columns numbers a task.  Values are shifted by rough medians (of
    at most 1,000 rows) first, so that neither large means nor odd values elsewhere cost
    digits; only a pair whose rows all lie far from the column's median, seen by their own
    spread, loses some.  ``corr`` is NULL where fewer than two rows have both or one of the
    columns is constant on them."""
    d = len(cols)
    numbers = df.select(F.transform(
        F.array(*[F.col(f"`{c}`").cast("double") for c in cols]),
        lambda x: F.coalesce(x, F.lit(float("nan")))).alias("x"))
    x = [F.col("x")[i] for i in range(d)]
    first = numbers.limit(1000).select(*[
        F.median(F.when(F.abs(v) < float("inf"), v)).alias(f"m{i}") for i, v in enumerate(x)]).first()
    shift = [float(m) if m is not None and math.isfinite(m) else 0.0 for m in first]

    def gram(batches):
        import numpy as np
        import pyarrow as pa

        total = np.zeros((4, d, d))
        for batch in batches:
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
            there = np.isfinite(x)
            x = np.where(there, x - np.array(shift), 0.0)
            m = there.astype(float)
            total += np.stack([m.T @ m, x.T @ m, (x * x).T @ m, x.T @ x])
        # of column i with every j: rows with both, and i's sums, squares and products there
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(d, dtype=np.int32))] + [
                pa.array(list(t), pa.list_(pa.float64())) for t in total],
            ["i", "n", "s", "q", "p"])

    parts = numbers.mapInArrow(gram, "i int, n array<double>, s array<double>, "
                                     "q array<double>, p array<double>")
    pairs = parts.select("i", F.posexplode(F.arrays_zip("n", "s", "q", "p")).alias("j", "v"))
    sums = pairs.groupBy("i", "j").agg(*[F.sum(f"v.{c}").alias(c) for c in "nsqp"])
    # the other column's sums over the same rows stand at (j, i)
    other = sums.select(F.col("j").alias("i"), F.col("i").alias("j"),
                        F.col("s").alias("so"), F.col("q").alias("qo"))
    both = sums.join(other, ["i", "j"])
    n = F.col("n")
    spread = (F.col("q") - F.col("s") * F.col("s") / n) * (
        F.col("qo") - F.col("so") * F.col("so") / n)
    # what rounding leaves of a constant column's spread is none
    least = F.lit(1e-24) * F.col("q") * F.col("qo")
    corr = F.when((n >= 2) & (spread > least), F.greatest(F.lit(-1.0), F.least(
        F.lit(1.0), (F.col("p") - F.col("s") * F.col("so") / n) / F.sqrt(spread))))
    names = F.array(*[F.lit(c) for c in cols])
    return both.select("i", "j", names[F.col("i")].alias("column_i"),
                       names[F.col("j")].alias("column_j"), n.cast("long").alias("n"),
                       F.when(F.col("i") == F.col("j"), F.when(corr.isNotNull(), 1.0))
                       .otherwise(corr).alias("corr"))


def describe_numeric(df: DataFrame, cols: Sequence[str],
                     probs: Sequence[float] = (0.25, 0.5, 0.75),
                     exact: bool = True) -> DataFrame:
    """D3 (pandas ``describe``): count, mean, std (sample), min, quartiles, max.

    ``exact=True`` gives interpolated quantiles identical to ``quantile_cont`` through a range
    search (see :mod:`vitrail.operators.quantiles`); ``exact=False`` uses one-pass
    sketches."""
    aggs = []
    for i, c in enumerate(cols):
        x = F.col(c).cast("double")
        aggs += [F.count(x).alias(f"count_{i}"), F.avg(x).alias(f"mean_{i}"),
                 F.stddev_samp(x).alias(f"std_{i}"), F.min(x).alias(f"min_{i}"),
                 F.max(x).alias(f"max_{i}")]
    basic = _unpivot_row(df.agg(*aggs), cols, ["count", "mean", "std", "min", "max"])
    quant = (exact_quantiles if exact else approx_quantiles)(df, cols, probs)
    labels = [_quantile_label(p) for p in probs]
    if len(set(labels)) != len(labels):
        raise ValueError(f"duplicate probabilities in {list(probs)}")
    wide = (quant.groupBy("feature")
                 .pivot("prob", [float(p) for p in probs])
                 .agg(F.first("value")))
    for p, name in zip(probs, labels):
        wide = wide.withColumnRenamed(str(float(p)), name)
    return (basic.join(wide, "feature", "left")
                 .select("idx", "feature", "count", "mean", "std", "min", *labels, "max")
                 .orderBy("idx"))


def _quantile_label(p: float) -> str:
    """0.25 -> q25, 0.5 -> q50, 0.999 -> q99_9, 1.0 -> q100."""
    pct = round(p * 100, 6)
    if pct == int(pct):
        return f"q{int(pct):02d}"
    return "q" + f"{pct:g}".replace(".", "_")
