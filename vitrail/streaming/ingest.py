"""Delimited ingest on a stream of text files.

The batch parser is a chain of stateless column expressions, so the same plan runs on
``readStream``: each micro-batch is parsed with ``from_csv`` over the full width, header
repeats and malformed lines are separated, and the typed rows go to any sink.  The header
cannot be peeked from a stream, so the column names are given.  Malformed-line counts are
a streaming aggregate (complete mode).  The caller names each query's checkpoint folder, so
that a restarted query goes on where it stopped.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from vitrail.sources import delimited


def read_text_stream(spark: SparkSession, source_dir: str,
                     max_files_per_trigger: int | None = None) -> DataFrame:
    """New files of ``source_dir`` as a stream of lines (``value``)."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(source_dir)


def parse_stream(lines: DataFrame, sep: str, names: Sequence[str],
                 accents: bool = True) -> delimited.Parsed:
    """Tokenise a line stream against known header names (header lines are dropped)."""
    names = list(names)
    rows = delimited.tokenize(lines, sep, len(names), accents)
    rows = rows.filter(~delimited._is_header(names))
    return delimited.Parsed(delimited.column_names(names), names, rows)


def typed_stream(parsed: delimited.Parsed,
                 types: Sequence[str] | Mapping[str, str] | None = None) -> DataFrame:
    """Well-formed rows with NULLs, quotes and declared types applied."""
    return delimited.coerce(delimited.good_rows(parsed), parsed.names, types)


def profile_stream(parsed: delimited.Parsed, name: str) -> DataFrame:
    """Running (n_rows, n_malformed) over everything the stream has seen."""
    return delimited.profile(parsed, name)


def start(df: DataFrame, checkpoint: str, sink: str = "parquet", path: str | None = None,
          output_mode: str = "append", query_name: str | None = None,
          available_now: bool = False) -> StreamingQuery:
    """Start ``df`` with its progress in ``checkpoint``; the same folder resumes it."""
    writer = (df.writeStream.format(sink).outputMode(output_mode)
                .option("checkpointLocation", checkpoint))
    if query_name is not None:
        writer = writer.queryName(query_name)
    if available_now:
        writer = writer.trigger(availableNow=True)
    if path is not None:
        return writer.start(path)
    return writer.start()


def malformed_lines(parsed: delimited.Parsed) -> DataFrame:
    """The rejected lines themselves, for a dead-letter sink."""
    return parsed.rows.filter(F.col(delimited.MALFORMED)).select("value")
