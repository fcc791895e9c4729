"""Labelled-point, libsvm and edge-list sources (A11-A14), all as column expressions.

Tokens are split with ``split`` and converted with ``try_cast`` (ANSI mode raises on dirty
text otherwise); vectors are built with ``array_to_vector`` in the JVM.  Lines that do not
have the expected width, or hold something that is no number, are set apart and counted,
like malformed rows of delimited text.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrail.sources.delimited import first_file_lines, read_lines


def _tokens(sep: str):
    return F.split(F.trim(F.col("value")), re.escape(sep) if sep != " " else " +")


BAD = "_bad"


def first_point_line(lines: DataFrame) -> str | None:
    """The first line that is not blank, in the order of the frame's partitions: right for
    one file or a frame put in order.  For several files Spark orders splits by size; give
    ``header_source=delimited.first_file_lines(...)`` then."""
    row = lines.where(F.length(F.trim("value")) > 0).select("value").limit(1).first()
    return None if row is None else row["value"]


def _is_number_line(line: str, sep: str) -> bool:
    try:
        for token in re.split(re.escape(sep) if sep != " " else " +", line.strip()):
            float(token)
    except ValueError:
        return False
    return True


def _common_width(lines: DataFrame, sep: str) -> int:
    """The most frequent number of fields among lines that are not blank, the larger of
    equals; 0 without lines.  One map-side combined aggregate."""
    widths = lines.where(F.length(F.trim("value")) > 0).groupBy(
        F.size(_tokens(sep)).alias("w")).count().orderBy(F.desc("count"), F.desc("w"))
    row = widths.limit(1).first()
    return 0 if row is None else row["w"]


def tag_labeled_points(lines: DataFrame, sep: str = " ", label_index: int = 0,
                       feature_indices: Sequence[int] | None = None,
                       width: int | None = None, drop_header: bool = False,
                       header_source: DataFrame | None = None) -> DataFrame:
    """``value, label double, features array<double>, _bad`` for every line that
    is not blank.  A line is bad when a field is no number or the width is not ``width``,
    by default the most frequent one (one small aggregate), so that a short or odd first
    line spoils nothing.

    ``drop_header`` drops every line equal to the first line of ``header_source`` (by
    default of ``lines``), unless that line is all numbers: then no file has a header and
    the line is data."""
    lines = lines.where(F.length(F.trim("value")) > 0)
    if drop_header:
        first = first_point_line(header_source if header_source is not None else lines)
        if first is not None and not _is_number_line(first, sep):
            lines = lines.where(F.col("value") != F.lit(first))
    if width is None:
        width = _common_width(lines, sep)
    parts = _tokens(sep)
    numbers = F.transform(parts, lambda x: x.try_cast("double"))
    wanted = list(feature_indices) if feature_indices is not None else [
        i for i in range(width) if i != label_index % width]
    bad = (F.size(parts) != width) | F.exists(numbers, lambda x: x.isNull())
    return lines.select("value", F.get(numbers, F.lit(label_index % max(width, 1))).alias("label"),
                        F.array(*[F.get(numbers, F.lit(i)) for i in wanted]).alias("features"),
                        bad.alias(BAD))


def parse_labeled_points(lines: DataFrame, sep: str = " ", label_index: int = 0,
                         feature_indices: Sequence[int] | None = None,
                         as_vector: bool = True, drop_header: bool = False,
                         width: int | None = None,
                         header_source: DataFrame | None = None) -> DataFrame:
    """Lines of numbers -> ``label double, features``.

    ``feature_indices=None`` takes every field except the label, in order (A12: label
    first; A13: label at index 8, features 0..7).  Blank and bad lines are left out;
    :func:`tag_labeled_points` shows them and :func:`points_profile` counts them."""
    tagged = tag_labeled_points(lines, sep, label_index, feature_indices, width, drop_header,
                                header_source)
    out = tagged.where(~F.col(BAD)).select("label", "features")
    if as_vector:
        # bad lines reach the vector builder too if their filter runs after it
        whole = F.transform("features", lambda x: F.coalesce(x, F.lit(0.0)))
        out = out.select("label", array_to_vector(whole).alias("features"))
    return out


def load_labeled_points(spark: SparkSession, path: str | Sequence[str], sep: str = " ",
                        label_index: int = 0, feature_indices: Sequence[int] | None = None,
                        as_vector: bool = True, drop_header: bool = False,
                        width: int | None = None, encoding: str = "UTF-8") -> DataFrame:
    """A12 / A13 on file(s), of which the first in path order, or all, may have a header."""
    first = first_file_lines(spark, path, encoding) if drop_header else None
    return parse_labeled_points(read_lines(spark, path, encoding), sep, label_index,
                                feature_indices, as_vector, drop_header, width, first)


def points_profile(tagged: DataFrame) -> DataFrame:
    """``(n_rows, n_bad)`` of tagged points or edges."""
    return tagged.agg(F.count_if(~F.col(BAD)).alias("n_rows"), F.count_if(BAD).alias("n_bad"))


def tag_edges(lines: DataFrame, sep: str = " ") -> DataFrame:
    """``value, src long, dst long, weight double, _bad`` for every line that is not
    blank; ids are whole numbers of 64 bits and never pass through a double."""
    parts = _tokens(sep)
    src, dst = (F.get(parts, F.lit(i)).try_cast("bigint") for i in (0, 1))
    weight = F.get(parts, F.lit(2)).try_cast("double")
    return lines.where(F.length(F.trim("value")) > 0).select(
        "value", src.alias("src"), dst.alias("dst"), weight.alias("weight"),
        ((F.size(parts) != 3) | src.isNull() | dst.isNull() | weight.isNull()).alias(BAD))


def parse_edges(lines: DataFrame, sep: str = " ") -> DataFrame:
    """``src dst weight`` lines -> ``src long, dst long, weight double``; bad lines are
    left out (:func:`tag_edges`, :func:`points_profile`)."""
    return tag_edges(lines, sep).where(~F.col(BAD)).select("src", "dst", "weight")


# What can be wrong with a libsvm line, in the order in which it is looked for (fixed values).
LIBSVM_FAULTS = ("label", "token", "index", "repeat", "order")


def tag_libsvm(lines: DataFrame, num_features: int | None = None) -> DataFrame:
    """``value, label double, indices array<int> (from 0), values array<double>, fault``
    for every line that is neither blank nor a comment (``#`` to the end of the line).

    ``fault`` is NULL for a good line, else the first of: ``label`` is no number; a ``token``
    is not ``index:value`` with a whole number and a number; an ``index`` is below 1 or above
    ``num_features``; a ``repeat``ed index; indices out of ``order``.  Narrow projections; the
    line is split once, and each token once, behind generates."""
    body = F.trim(F.when(F.contains("value", F.lit("#")), F.regexp_replace(
        "value", r"#.*$", "")).otherwise(F.col("value")))
    cut = lines.select("value", F.explode(F.array(body)).alias("_b")).where(F.length("_b") > 0)
    cut = cut.select("value", F.explode(F.array(F.split("_b", r"\s+"))).alias("_t"))
    pairs = F.slice("_t", 2, F.greatest(F.size("_t") - 1, F.lit(0)))
    read = cut.select(F.inline(F.array(F.struct(
        F.col("value"), F.get("_t", F.lit(0)).try_cast("double").alias("label"),
        F.transform(pairs, lambda t: F.substring_index(t, ":", 1)).try_cast(
            "array<int>").alias("_at"),
        F.transform(pairs, lambda t: F.when(
            # what is after the only colon
            t.contains(":") & (F.substring_index(t, ":", 2) == t),
            F.substring_index(t, ":", -1))).try_cast("array<double>").alias("values")))))
    top = num_features if num_features is not None else (1 << 31) - 1
    fault = (F.when(F.col("label").isNull(), "label")
             .when(F.exists("_at", lambda i: i.isNull())
                   | F.exists("values", lambda v: v.isNull()), "token")
             .when((F.array_min("_at") < 1) | (F.array_max("_at") > top), "index")
             .when(F.size(F.array_distinct("_at")) < F.size("_at"), "repeat")
             .when(F.sort_array("_at") != F.col("_at"), "order"))
    return read.select("value", "label", F.transform("_at", lambda i: i - 1).alias("indices"),
                       "values", fault.alias("fault"))


def libsvm_profile(tagged: DataFrame, with_size: bool = False) -> DataFrame:
    """``(n_rows, n_label, n_token, n_index, n_repeat, n_order)``: good lines and those with
    each fault, from one aggregate; ``with_size`` adds ``n_features``, the largest index of
    a good line (0 without any), which :func:`parse_libsvm` then need not look for."""
    good = F.col("fault").isNull()
    size = F.coalesce(F.max(F.when(good, F.array_max("indices"))) + 1, F.lit(0))
    return tagged.agg(F.count_if(good).alias("n_rows"), *[
        F.count_if(F.col("fault") == f).alias(f"n_{f}") for f in LIBSVM_FAULTS],
        *([size.alias("n_features")] if with_size else []))


def sparse_vector(indices: Column, values: Column, size: int) -> Column:
    """A sparse ML vector from its indices (ascending, from 0) and values.  The type can't be
    cast to: an Arrow function hands the arrays back, as they are, under the vector's type."""

    @F.arrow_udf(VectorUDT())
    def vectors(places: pa.Array, numbers: pa.Array) -> pa.Array:
        n = len(places)
        return pa.StructArray.from_arrays(
            [pa.repeat(pa.scalar(0, pa.int8()), n), pa.repeat(pa.scalar(size, pa.int32()), n),
             places, numbers], ["type", "size", "indices", "values"])

    return vectors(indices, values)


def parse_libsvm(lines: DataFrame, num_features: int | None = None) -> DataFrame:
    """The good lines as ``label double, features vector`` (sparse).  Without
    ``num_features`` it is the largest index of a good line (one aggregate)."""
    good = tag_libsvm(lines, num_features).where(F.col("fault").isNull())
    if num_features is None:
        num_features = good.agg(F.coalesce(F.max(F.array_max("indices")) + 1, F.lit(0))).first()[0]
    return good.select("label", sparse_vector(F.col("indices"), F.col("values"),
                                              num_features).alias("features"))


def read_libsvm(spark: SparkSession, path: str, num_features: int | None = None) -> DataFrame:
    """Libsvm file(s) -> ``label double, features vector`` (sparse)."""
    reader = spark.read.format("libsvm")
    if num_features is not None:
        reader = reader.option("numFeatures", str(num_features))
    return reader.load(path)


def write_libsvm(df: DataFrame, path: str, label: str = "label",
                 features: str = "features") -> None:
    """Write ``label`` + vector ``features`` as libsvm text (one part file per partition)."""
    (df.select(F.col(label).cast("double").alias("label"), F.col(features).alias("features"))
       .write.mode("overwrite").format("libsvm").save(path))


def features_as_array(df: DataFrame, col: str = "features") -> DataFrame:
    """Vector column -> array<double> (for SQL-side comparison and display)."""
    return df.withColumn(col, vector_to_array(col))
