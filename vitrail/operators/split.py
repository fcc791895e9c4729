"""Sampling and train/test splits.

Every decision is a hash, never a draw per partition, so a row lands in the same part
whatever the number of cores, files or partitions.  E4 hashes a key with the first 32 bits
of an MD5, which any SQL engine can repeat.

The seeded variants (E1-E3) draw for every copy of a row: equal rows are counted (one
map-side combined shuffle, so a row that makes up a third of the table is one row per
task) and the draw of a copy hashes the row, its copy number and the seed.  Which copy gets
which number doesn't matter, as they are equal.  Where ``keys`` tell the rows apart the
draw hashes the keys alone, and the split is a narrow projection like E4: no shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_HASH_RANGE = float(1 << 32)


def _check_weights(weights: Sequence[float]) -> list[float]:
    if not weights or any(w < 0 for w in weights) or sum(weights) <= 0:
        raise ValueError(f"weights must be non-negative with a positive sum: {weights}")
    total = float(sum(weights))
    bounds, acc = [], 0.0
    for w in weights:
        acc += w / total
        bounds.append(acc)
    bounds[-1] = 1.0
    return bounds


def key_hash(keys: Sequence[str], salt: str = "", method: str = "md5") -> Column:
    """Unsigned 32-bit hash of the keys.

    ``md5``: first 8 hex digits of md5('k1|k2|...|salt') -- reproducible in any SQL
    engine.  ``xxhash64``: Spark's native 64-bit hash of the typed keys, low 32 bits --
    several times cheaper per row, for splits that only Spark has to reproduce."""
    if method == "xxhash64":
        cols = [F.col(k) for k in keys] + ([F.lit(salt)] if salt else [])
        return F.xxhash64(*cols).bitwiseAND(F.lit(0xFFFFFFFF))
    if method != "md5":
        raise ValueError(f"unknown hash method {method!r}")
    parts = [F.col(k).cast("string") for k in keys]
    if salt:
        parts.append(F.lit(salt))
    digest = F.md5(F.concat_ws("|", *parts))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")


def _split_index(u: Column, bounds: list[float]) -> Column:
    expr = F.lit(len(bounds) - 1)
    for i in reversed(range(len(bounds) - 1)):
        expr = F.when(u < F.lit(bounds[i]), F.lit(i)).otherwise(expr)
    return expr


def hash_split_tag(df: DataFrame, keys: Sequence[str], weights: Sequence[float] = (0.6, 0.4),
                   salt: str = "", col: str = "split", method: str = "md5") -> DataFrame:
    """Add ``split`` (0-based index into ``weights``) from the key hash."""
    bounds = _check_weights(weights)
    u = key_hash(keys, salt, method) / F.lit(_HASH_RANGE)
    return df.withColumn(col, _split_index(u, bounds))


def hash_split(df: DataFrame, keys: Sequence[str], weights: Sequence[float] = (0.6, 0.4),
               salt: str = "", method: str = "md5") -> list[DataFrame]:
    """E4 as a list of DataFrames, like ``randomSplit`` but reproducible anywhere."""
    tagged = hash_split_tag(df, keys, weights, salt, "_split", method)
    return [tagged.filter(F.col("_split") == i).drop("_split") for i in range(len(weights))]


#: Copies of one row that a task lists; a row with more is dealt out in runs of so many.
RUN = 1 << 16
_COUNT, _RUN, _COPY = "_n_copies", "_run", "_copy"


def uniform(cols: Sequence[Column], seed: int, method: str = "xxhash64") -> Column:
    """A number in [0, 1) from the columns and the seed.  ``md5``: from 32 bits of
    md5('c1|c2|...|seed'), which leaves nulls out; reproducible in any SQL engine."""
    if method == "md5":
        digest = F.md5(F.concat_ws("|", *[c.cast("string") for c in cols], F.lit(str(int(seed)))))
        return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") / F.lit(_HASH_RANGE)
    if method != "xxhash64":
        raise ValueError(f"unknown hash method {method!r}")
    # hashed twice: neighbouring seeds and values then share no pattern
    h = F.xxhash64(F.lit(int(seed)).cast("bigint"), F.xxhash64(*cols))
    return F.call_function("shiftrightunsigned", h, F.lit(11)) / F.lit(float(1 << 53))


def _named(names: Sequence[str]) -> list[Column]:
    return [F.col(f"`{c}`") for c in names]


def numbered_copies(df: DataFrame, copy: str = _COPY) -> DataFrame:
    """``df`` with a number from 1 upwards for each of several equal rows (nulls are equal).

    Rows are grouped by all columns, which therefore can't be maps.  The copies of a row
    with more than ``RUN`` of them are dealt over the cluster in runs."""
    counts = df.groupBy(*_named(df.columns)).agg(F.count(F.lit(1)).alias(_COUNT))

    def listed(rows: DataFrame) -> DataFrame:
        first = F.col(_RUN) * RUN
        numbers = F.sequence(first + 1, F.least(F.col(_COUNT), first + RUN))
        return rows.select(*_named(df.columns), F.explode(numbers).alias(copy))

    few = listed(counts.where(F.col(_COUNT) <= RUN).withColumn(_RUN, F.lit(0).cast("long")))
    many = counts.where(F.col(_COUNT) > RUN).withColumn(_RUN, F.explode(F.sequence(
        F.lit(0).cast("long"), F.floor((F.col(_COUNT) - 1) / RUN))))
    return few.unionAll(listed(many.repartition(F.xxhash64(*_named(df.columns), _RUN))))


def _drawn(df: DataFrame, seed: int, keys: Sequence[str] | None,
           method: str) -> tuple[DataFrame, Column]:
    """Rows and, for each, its draw in [0, 1)."""
    if keys is not None:
        return df, uniform(_named(keys), seed, method)
    return numbered_copies(df), uniform([*_named(df.columns), F.col(_COPY)], seed, method)


def random_split_tag(df: DataFrame, weights: Sequence[float], seed: int, col: str = "split",
                     keys: Sequence[str] | None = None, method: str = "xxhash64") -> DataFrame:
    """``split`` (0-based index into ``weights``), drawn for every copy of a row."""
    bounds = _check_weights(weights)
    rows, u = _drawn(df, seed, keys, method)
    return rows.select(*_named(df.columns), _split_index(u, bounds).alias(col))


def random_split(df: DataFrame, weights: Sequence[float], seed: int,
                 keys: Sequence[str] | None = None, method: str = "xxhash64") -> list[DataFrame]:
    """E2/E3 as a list of DataFrames; the seed is required."""
    tagged = random_split_tag(df, weights, seed, "_split", keys, method)
    return [tagged.filter(F.col("_split") == i).drop("_split") for i in range(len(weights))]


def sample_rows(df: DataFrame, fraction: float, seed: int, keys: Sequence[str] | None = None,
                method: str = "xxhash64") -> DataFrame:
    """Sample without replacement, each row (each copy of equal rows too) kept with
    probability ``fraction``; the seed is required."""
    if not 0.0 <= fraction <= 1.0:
        raise ValueError(f"fraction {fraction} outside [0, 1]")
    rows, u = _drawn(df, seed, keys, method)
    return rows.where(u < F.lit(float(fraction))).select(*_named(df.columns))
