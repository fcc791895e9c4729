"""Shared pieces of the corpus operators."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrail.session import scratch_path

#: What separates words: space and the ASCII controls tab to carriage return.
GAP = r"[\x20\x09-\x0D]+"
GAP_CHARS = " \t\n\x0b\f\r"

#: Stands for a missing integer id where rows are grouped by id; sorts before all others.
NO_ID = -(1 << 63)


def text_of(column: str | Column) -> Column:
    """The text with null read as empty."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def words_of(text: Column) -> Column:
    """Array of the words of a text: maximal runs of characters outside ``GAP``."""
    return F.array_remove(F.split(text, GAP), "")


def carried(docs: DataFrame, added: list[str]) -> list[str]:
    """The columns of ``docs`` that an operator passes on: all but those it adds itself."""
    own = {c.lower() for c in added}
    return [c for c in docs.columns if c.lower() not in own]


def packed(names: list[str]) -> Column:
    """The passed-on columns as one struct ``_row``, out of reach of working columns that
    may have the same names."""
    return F.struct(*[F.col(f"`{c}`") for c in names]).alias("_row")


def unpacked(names: list[str]) -> list[Column]:
    return [F.col("_row")[c].alias(c) for c in names]


#: Bytes of rows that Spark hands to a Python worker at once.
BATCH_BYTES = 8 << 20
_BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"


def bounded_batches(spark: SparkSession) -> None:
    """Makes Arrow batches of whole texts no larger than ``BATCH_BYTES``: lowers the
    session's setting (64 MB by default, which both sides of every task would hold), and
    leaves a smaller one as it is."""
    now = spark.conf.get(_BATCH_CONF, None)
    number = int(re.sub(r"\D", "", now)) if now and re.fullmatch(r"\d+b?", now) else None
    if number is None or number > BATCH_BYTES:
        spark.conf.set(_BATCH_CONF, str(BATCH_BYTES))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as a table below the session's shared checkpoint folder and
    read back: the lineage is cut and a lost executor loses nothing.  The caller may
    remove the tables of a finished job with :func:`release`."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    _paths(spark).append(path)
    return spark.read.schema(df.schema).parquet(path)


def _paths(spark: SparkSession) -> list[str]:
    if not hasattr(spark, "_vitrail_llm_tables"):
        spark._vitrail_llm_tables = []
    return spark._vitrail_llm_tables


def marker(spark: SparkSession) -> int:
    """Position in the list of written tables, for :func:`release`."""
    return len(_paths(spark))


def remember(spark: SparkSession, path: str) -> None:
    """Add a folder made by other means to those :func:`release` removes."""
    _paths(spark).append(path)


def release(spark: SparkSession, since: int = 0, keep: int = 0) -> None:
    """Remove the tables written since ``marker`` but for the last ``keep``; results that
    read them must have been consumed by then."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    paths = _paths(spark)
    gone = paths[since:len(paths) - keep]
    del paths[since:len(paths) - keep]
    for name in gone:
        path = jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(conf).delete(path, True)
