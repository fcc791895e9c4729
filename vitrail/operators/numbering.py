"""Row numbers, running sums and positional pairing of whole tables.

No global window: a table is dealt into ranges of its order (or keeps the partitions it
has), every part is numbered or summed on its own, and the totals of the parts below it
are added.  Parts are fixed by a reliable checkpoint, so a task that is run again sees the
rows it saw before.  What reaches the driver or is broadcast is one row per part.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vitrail.session import cut_lineage

#: ``monotonically_increasing_id`` holds the partition above these bits, the row below.
_ROW_BITS = 33


def _columns(order: Sequence[str | Column]) -> list[Column]:
    return [F.col(f"`{c}`") if isinstance(c, str) else c for c in order]


def in_ranges(df: DataFrame, order: Sequence[str | Column], part: str = "_part") -> DataFrame:
    """``df`` dealt into sorted ranges of ``order``, with the range's number; kept by a
    checkpoint.  A key that many rows share is spread by the columns after it."""
    keys = _columns(order)
    dealt = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    return cut_lineage(dealt.withColumn(part, F.spark_partition_id()))


def number_rows(df: DataFrame, order: Sequence[str | Column] | None = None,
                col: str = "row_number") -> DataFrame:
    """``df`` with gapless numbers from 0, by ``order`` or else by the place of a row in its
    partitions."""
    if order is not None:
        keys = _columns(order)
        df = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    kept = cut_lineage(df.withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftright("_at", _ROW_BITS)
    sizes = kept.groupBy(part.alias("_p")).count().orderBy("_p").collect()  # one per part
    before, total = [], 0
    for r in sizes:
        before.append((r["_p"], total))
        total += r["count"]
    offsets = df.sparkSession.createDataFrame(before, "_p long, _before long")
    place = F.col("_at").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    # an inner join: every part has its row; as many rows as there are parts
    return kept.withColumn("_p", part).join(F.broadcast(offsets), "_p").withColumn(
        col, place + F.col("_before")).drop("_p", "_before", "_at")


def running_sums(df: DataFrame, order: Sequence[str], sums: dict[str, Column],
                 by: Sequence[str] = ()) -> DataFrame:
    """``df`` with, for every ``name: value`` of ``sums``, the sum of the value over the rows
    before it in ``order`` within its group ``by`` (nulls are a group); the row itself is
    not counted, null values count 0.  Rows that ``order`` can't tell apart follow each
    other in any way.  A group of any size is spread over the ranges of (by, order)."""
    groups = [f"`{c}`" for c in by]
    values = {n: F.coalesce(v, F.lit(0)) for n, v in sums.items()}
    rows = in_ranges(df.withColumns({f"_v_{n}": v for n, v in values.items()}),
                     [*by, *order])
    parts = rows.groupBy("_part", *groups).agg(
        *[F.sum(f"_v_{n}").alias(f"_t_{n}") for n in sums])
    below = Window.partitionBy(*groups).orderBy("_part").rowsBetween(
        Window.unboundedPreceding, -1)
    # only the first group of a range can have begun in a range below: one row per range
    parts = parts.select(F.col("_part").alias("_op"), F.count(F.lit(1)).over(below).alias("_k"), *[
        F.col(g).alias(f"_o{i}") for i, g in enumerate(groups)], *[
        F.sum(f"_t_{n}").over(below).alias(f"_b_{n}") for n in sums]).where("_k > 0").drop("_k")
    match = F.col("_part") == F.col("_op")
    for i, g in enumerate(groups):
        match = match & F.col(g).eqNullSafe(F.col(f"_o{i}"))
    own = Window.partitionBy("_part", *groups).orderBy(*[
        F.col(f"`{c}`") for c in order]).rowsBetween(Window.unboundedPreceding, -1)
    out = rows.withColumns({n: F.coalesce(F.sum(f"_v_{n}").over(own), F.lit(0)) for n in sums})
    out = out.join(F.broadcast(parts), match, "left").withColumns({
        n: F.col(n) + F.coalesce(F.col(f"_b_{n}"), F.lit(0)) for n in sums})
    return out.drop("_part", "_op", *[f"_o{i}" for i in range(len(groups))],
                    *[f"_{k}_{n}" for n in sums for k in "vb"])


#: Rows of one part of a whole table: 100 to 200 MB where a task sorts them.
PART_ROWS = 1 << 20


def parts_for(rows: int, least: int) -> int:
    """Into how many parts so many rows are dealt: tasks grow in number, not in size."""
    return max(least, -(-rows // PART_ROWS))


def _shuffle_parts(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def file_order(df: DataFrame) -> DataFrame:
    """``df`` (read from files, nothing else done to it) as a frame whose partitions follow
    the order of the lines: by path, then by place in the file.  Spark packs splits by size,
    so partitions alone don't.  Rows are counted first: by path (one row per file comes to
    the driver), so that a row carries the number of its path instead of the path."""
    names = df.columns
    path = F.col("_metadata.file_path")
    sizes = df.select(path.alias("_path")).groupBy("_path").count().orderBy("_path").collect()
    numbers = df.sparkSession.createDataFrame(
        [(r["_path"], i) for i, r in enumerate(sizes)], "_path string, _file int")
    placed = df.select("*", path.alias("_path"),
                       F.col("_metadata.file_block_start").alias("_start"),
                       F.monotonically_increasing_id().alias("_in_split"))
    # a left join, as a row must not be lost
    placed = placed.join(F.broadcast(numbers), "_path", "left").drop("_path")
    keys = ["_file", "_start", "_in_split"]
    parts = parts_for(sum(r["count"] for r in sizes), _shuffle_parts(df))
    return placed.repartitionByRange(parts, *keys).sortWithinPartitions(*keys).select(*names)


def pair_rows(left: DataFrame, right: DataFrame) -> DataFrame:
    """The n-th row of ``left`` beside the n-th of ``right``, whatever their partitions.

    Raises where the frames differ in length or share a column name.  Frames read from
    files are put in order by :func:`file_order` first."""
    clash = {c.lower() for c in left.columns} & {c.lower() for c in right.columns}
    if clash:
        raise ValueError(f"both frames have columns {sorted(clash)}")
    a, b = number_rows(left, col="_n"), number_rows(right, col="_n")
    sizes = a.count(), b.count()
    if sizes[0] != sizes[1]:
        raise ValueError(f"frames of different length: {sizes[0]} and {sizes[1]} rows")
    usual = _shuffle_parts(left)
    if (parts := parts_for(sizes[0], usual)) > usual:
        a, b = a.repartition(parts, "_n"), b.repartition(parts, "_n")
    return a.join(b, "_n").drop("_n")
