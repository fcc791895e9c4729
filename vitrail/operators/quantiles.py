"""Exact, distributed quantiles with linear interpolation (``quantile_cont`` semantics).

An exact percentile aggregate keeps every distinct value of a column in one task, and a
global sort moves the table for a dozen numbers.  Instead the ranks that the quantiles need
are found by narrowing value ranges: a pass cuts the range that holds a rank into
``CUTS`` equal parts and takes, for each part, the number of values and the smallest and
largest of them (one aggregate with map-side partial results).  The part that holds the
rank, from its smallest to its largest value, is the next range, until both are equal.
Ranks of all columns are searched in the same passes.  A pass reads the needed columns
once; the number of passes depends on the values only (one where a column has few, two or
three for decimals), the rows that reach the driver on columns x quantiles x ``CUTS``.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CUTS = 2048

Range = tuple[int, float, float]  # column, smallest, largest value


def _part(v: Column, low: float, high: float) -> Column:
    """The number of the part that a value between ``low`` and ``high`` falls into."""
    if math.isinf(high - low):  # halves, whose difference is finite
        share = (v / 2 - low / 2) / (high / 2 - low / 2)
    else:
        share = (v - low) / (high - low)
    return F.least(F.floor(share * CUTS), F.lit(CUTS)).cast("int")


def _counts(df: DataFrame, ranges: Sequence[Range]) -> dict[int, list[tuple]]:
    """For each range the parts that hold values: (part, count, smallest, largest)."""
    entries = []
    for k, (column, low, high) in enumerate(ranges):
        v = F.col(f"x{column}")
        held = (v >= low) & (v <= high) & ~F.isnan(v)
        part = F.when(held, _part(v, low, high) if low < high else F.lit(0))
        entries.append(F.when(part.isNotNull(), F.struct(
            F.lit(k).alias("k"), part.alias("part"), v.alias("v"))))
    found = df.select(F.explode(F.array_compact(F.array(*entries))).alias("e")).groupBy(
        "e.k", "e.part").agg(F.count(F.lit(1)), F.min("e.v"), F.max("e.v"))
    out: dict[int, list[tuple]] = {k: [] for k in range(len(ranges))}
    for k, *rest in found.collect():
        out[k].append(tuple(rest))
    return {k: sorted(parts) for k, parts in out.items()}


def _whole(df: DataFrame, n_cols: int) -> list[tuple]:
    """Per column: the numbers of -inf, finite, +inf and NaN values, and the finite range."""
    aggs = []
    for i in range(n_cols):
        v = F.col(f"x{i}")
        finite = ~F.isnan(v) & (F.abs(v) < float("inf"))
        aggs += [F.count_if(v == float("-inf")), F.count_if(finite),
                 F.count_if(v == float("inf")), F.count_if(F.isnan(v)),
                 F.min(F.when(finite, v)), F.max(F.when(finite, v))]
    row = df.agg(*[a.alias(f"a{i}") for i, a in enumerate(aggs)]).first()
    return [tuple(row[6 * i:6 * i + 6]) for i in range(n_cols)]


def _select(df: DataFrame, wanted: dict[tuple[int, int], None], n_cols: int,
            whole: list[tuple]) -> dict[tuple[int, int], float]:
    """The values at the wanted (column, rank); ranks from 0, NaN above all numbers."""
    found: dict[tuple[int, int], float] = {}
    open_: dict[Range, list[tuple[tuple[int, int], int]]] = {}
    for column, rank in wanted:
        below, finite, above, _, low, high = whole[column]
        if rank < below:
            found[column, rank] = -math.inf
        elif rank < below + finite:
            open_.setdefault((column, low, high), []).append(((column, rank), rank - below))
        else:
            found[column, rank] = math.inf if rank < below + finite + above else math.nan
    while open_:
        ranges = list(open_)
        next_: dict[Range, list] = {}
        for r, parts in _counts(df, ranges).items():
            for target, rank in open_[ranges[r]]:
                for _, n, low, high in parts:
                    if rank < n:
                        break
                    rank -= n
                if low == high:
                    found[target] = low
                else:
                    next_.setdefault((target[0], low, high), []).append((target, rank))
        open_ = next_
    return found


def exact_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """``(feature, prob, value)`` for every column and probability; NULLs ignored, NaN above
    all numbers.

    ``value = lo + (pos - floor(pos)) * (hi - lo)`` with ``pos = prob * (n - 1)``; a column
    without values has no rows."""
    for p in probs:
        if not 0.0 <= p <= 1.0:
            raise ValueError(f"probability {p} outside [0, 1]")
    cols = list(cols)
    numbers = df.select(*[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(cols)])
    whole = _whole(numbers, len(cols))
    at = [(i, p, p * (sum(whole[i][:4]) - 1)) for i in range(len(cols)) if sum(whole[i][:4])
          for p in probs]
    wanted = {(i, rank): None for i, _, pos in at for rank in (math.floor(pos), math.ceil(pos))}
    value = _select(numbers, wanted, len(cols), whole)
    rows = []
    for i, p, pos in at:
        low, high = value[i, math.floor(pos)], value[i, math.ceil(pos)]
        mixed = low if low == high else low + (pos - math.floor(pos)) * (high - low)
        rows.append((cols[i], float(p), mixed))
    return df.sparkSession.createDataFrame(rows, "feature string, prob double, value double")


def approx_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float],
                     accuracy: int = 10000) -> DataFrame:
    """One-pass approximate quantiles (map-side sketches), same output shape."""
    aggs = [F.percentile_approx(F.col(c).cast("double"), list(probs), accuracy).alias(f"q{i}")
            for i, c in enumerate(cols)]
    row = df.agg(*aggs)
    entries = [F.struct(F.lit(c).alias("feature"), F.col(f"q{i}").alias("vals"))
               for i, c in enumerate(cols)]
    qs = F.array(*[F.lit(float(p)) for p in probs])
    return (row.select(F.explode(F.array(*entries)).alias("e"))
               .select("e.feature", F.arrays_zip(qs.alias("prob"), F.col("e.vals").alias("value")).alias("z"))
               .select("feature", F.explode("z").alias("z"))
               .select("feature", F.col("z.prob").alias("prob"), F.col("z.value").cast("double").alias("value")))
