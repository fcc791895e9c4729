"""Delimited text ingest with full accounting of malformed rows (A1-A10).

The whole path is one Catalyst plan: ``read.text`` -> optional accent fold -> ``from_csv``
over an all-string schema with a corrupt-record column -> header / width filters ->
typed projection.  Only the header line crosses to the driver (one tiny job), because the
column names and width come from it.

Semantics kept from the original loader:
  * every line equal to the header is dropped (also right for concatenated files);
  * a row is malformed when its width differs from the header's; a blank line counts as
    malformed (it has zero fields);
  * a field that is empty becomes NULL, other values lose their double quotes;
  * declared types use the type words below; anything else is an error;
  * a value that its declared type cannot hold becomes NULL and is counted by the typed
    profile; ``on_bad="raise"`` makes it an error instead.
"""

from __future__ import annotations

import codecs
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitrail.functions.text import strip_accents as _strip_accents
from vitrail.functions.text import strip_quotes
from vitrail.operators.split import sample_rows

CORRUPT = "_corrupt"
BOM = "\ufeff"
MALFORMED = "_malformed"

# The loader's type words and the Spark types they stand for.
TYPE_WORDS: dict[str, T.DataType] = {
    "str": T.StringType(),
    "number": T.FloatType(),
    "bin": T.IntegerType(),
    "date": T.DateType(),
}
# Words beyond the loader's own: whole numbers and decimals that need 64 bits.
WIDE_WORDS: dict[str, T.DataType] = {"long": T.LongType(), "double": T.DoubleType()}


# Charsets of several bytes per character in which a line feed is one byte
# that is part of no other character, and those in which it is as wide as all others.
MULTI_BYTE = ("shift_jis", "shift_jis_2004", "cp932", "euc_jp", "euc_kr", "cp949", "gb2312",
              "gbk", "gb18030", "big5", "big5hkscs")
WIDE = {"utf-16-le": "UTF-16LE", "utf-16-be": "UTF-16BE",
        "utf-32-le": "UTF-32LE", "utf-32-be": "UTF-32BE"}


def read_lines(spark: SparkSession, path: str | Sequence[str], encoding: str = "UTF-8",
               partitions: int | None = None) -> DataFrame:
    """A1: one row per line, column ``value``, blank lines included.  Splits follow
    ``maxPartitionBytes``; ``partitions`` deals the lines anew, for small inputs that one
    split would leave to one task.

    The text source hands on the bytes of a line.  They are UTF-8; or, in a charset of one
    byte per character, read as ISO-8859-1 and then put right by a table of the 128 upper
    characters derived from the codec; or, in a charset of ``MULTI_BYTE`` or ``WIDE``,
    decoded by the codec, batch by batch.  Bytes that are no character become U+FFFD.
    Wide files are split at line feeds of their width; ``UTF-16`` and ``UTF-32`` take the
    byte order from the mark that opens the first file.  A line of a wide file whose bytes
    don't make whole characters fails the job: its separator lay across two characters.
    Charsets with shift states raise."""
    paths = path if isinstance(path, str) else list(path)
    name = codecs.lookup(encoding).name
    if name in ("utf-16", "utf-32"):
        name = _byte_order(spark, paths, name)
    reader = spark.read
    if name in WIDE:
        reader = reader.option("encoding", WIDE[name]).option("lineSep", "\n")
    lines = reader.text(paths)
    if partitions is not None:
        lines = lines.repartition(partitions)
    if name == "utf-8":
        return lines
    if name in WIDE or name in MULTI_BYTE:
        raw = F.col("value").cast("binary")
        if name in WIDE:
            width = 2 if "16" in name else 4
            raw = F.when(F.octet_length(raw) % width == 0, raw).otherwise(F.raise_error(F.lit(
                f"a line feed of {WIDE[name]} across two characters")).cast("binary"))
        return lines.select(_decoder(name)(raw).alias("value"))
    wrong, right = _upper_characters(encoding)
    latin = F.decode(F.col("value").cast("binary"), "ISO-8859-1")
    return lines.select((F.translate(latin, wrong, right) if wrong else latin).alias("value"))


def _decoder(name: str):
    """An Arrow function from the bytes of lines to text, without a carriage return at the
    end."""

    @F.arrow_udf("string")
    def decode(raw: pa.Array) -> pa.Array:
        return pa.array([None if b is None else b.decode(name, "replace").removesuffix("\r")
                         for b in raw.to_pylist()], pa.string())

    return decode


def _byte_order(spark: SparkSession, paths: str | list[str], name: str) -> str:
    """``utf-16`` or ``utf-32`` with the byte order of the mark that opens the first file."""
    first = spark.read.format("binaryFile").load(paths).agg(F.min("path")).first()[0]
    row = None if first is None else spark.read.text(first).select(
        F.substring(F.col("value").cast("binary"), 1, 4).alias("b")).limit(1).first()
    opens = b"" if row is None else bytes(row["b"])
    little, big = {"utf-16": (codecs.BOM_UTF16_LE, codecs.BOM_UTF16_BE),
                   "utf-32": (codecs.BOM_UTF32_LE, codecs.BOM_UTF32_BE)}[name]
    if opens.startswith(little):
        return f"{name}-le"
    if opens.startswith(big) or not opens:
        return f"{name}-be"
    raise ValueError(f"{first} opens with no byte order mark: say {name}le or {name}be")


def _upper_characters(encoding: str) -> tuple[str, str]:
    """(as ISO-8859-1, as ``encoding``) for the bytes that differ; raises for charsets that
    do not extend ASCII by one byte per character."""
    wrong, right = [], []
    for byte in range(256):
        char = bytes([byte]).decode(encoding, "replace")
        if len(char) != 1 or (byte < 128 and char != chr(byte)):
            raise ValueError(f"{encoding} does not extend ASCII by single bytes")
        if char != chr(byte):
            wrong.append(chr(byte))
            right.append(char)
    if any(len(bytes([a, b]).decode(encoding, "replace")) != 2
           for a in range(128, 256) for b in range(64, 256)):
        raise ValueError(f"{encoding} does not extend ASCII by single bytes")
    return "".join(wrong), "".join(right)


def header_of(lines: DataFrame, sep: str, accents: bool = False) -> list[str]:
    """A3: tokens of the first line (small jobs; nothing else leaves the cluster).  Spark's
    CSV functions split it, with the options of the rows."""
    col = _strip_accents("value") if accents else F.col("value")
    first = lines.limit(1).select(col.alias("value")).first()
    if first is None:
        raise ValueError("empty input: no header line")
    line = F.lit(first["value"].removeprefix(BOM))
    one = lines.sparkSession.range(1)
    kind = one.select(F.schema_of_csv(line, _csv_options(sep)).alias("s")).first()["s"]
    fields = one.select(F.from_csv(line, _all_strings(kind), _csv_options(sep)).alias("h"))
    return [token if token is not None else "" for token in fields.first()["h"]]


def _csv_options(sep: str, quote: str = '"') -> dict[str, str]:
    # a doubled quote inside a quoted field is a literal quote (RFC 4180), as in the
    # original's csv reader; Spark's default escape is a backslash
    return {"sep": sep, "quote": quote, "escape": quote, "mode": "PERMISSIVE"}


def _all_strings(kind: str) -> str:
    width = len(T.DataType.fromDDL(kind).fields)
    return ", ".join(f"`_c{i}` STRING" for i in range(width))


def column_names(tokens: Sequence[str]) -> list[str]:
    """Header tokens -> column names (double quotes removed)."""
    return [t.replace('"', "") for t in tokens]


def build_schema(type_words: Sequence[str], names: Sequence[str]) -> T.StructType:
    """StructType from type words. Raises on a length mismatch or an unknown word."""
    if len(type_words) != len(names):
        raise ValueError(
            f"{len(type_words)} types for {len(names)} columns: the counts must match")
    fields = []
    for word, name in zip(type_words, names):
        known = TYPE_WORDS | WIDE_WORDS
        if word not in known:
            raise ValueError(f"unknown type word {word!r}; expected one of {sorted(known)}")
        fields.append(T.StructField(name.replace('"', ""), known[word], True))
    return T.StructType(fields)


def _string_schema_ddl(width: int) -> str:
    cols = ", ".join(f"`_c{i}` STRING" for i in range(width))
    return f"{cols}, `{CORRUPT}` STRING"


def tokenize(lines: DataFrame, sep: str, width: int, accents: bool = False,
             quote: str = '"') -> DataFrame:
    """A2 + A5 input: parse each line into ``width`` string fields ``_c0.._c{w-1}``.

    Adds ``_malformed``: the line has another width than ``width`` or is blank.
    The parse always covers every field, so pruning cannot hide width errors.
    """
    raw = F.col("value")
    # a byte-order mark opens some files (each part file may carry one): drop it
    raw = F.when(raw.startswith(BOM), F.substring(raw, 2, 1 << 30)).otherwise(raw)
    value = _strip_accents(raw) if accents else raw
    opts = _csv_options(sep, quote) | {"columnNameOfCorruptRecord": CORRUPT}
    # inline(array(struct)) is a Generate: the parse runs once per line and later
    # projections cannot re-inline it per field (nor prune it to fewer columns, which
    # would hide width errors).
    # The line itself also comes out of the generate: a filter on it (the blank-line
    # test) then cannot be pushed below the parse, where it would re-evaluate the whole
    # line expression a second time.
    parsed = lines.select(value.alias("_line")).select(F.inline(F.array(F.struct(
        F.col("_line").alias("value"),
        F.from_csv("_line", _string_schema_ddl(width), opts).alias("_r")))))
    malformed = F.col(f"_r.{CORRUPT}").isNotNull() | (F.length("value") == 0)
    return parsed.select(
        "value", *[F.col(f"_r._c{i}").alias(f"_c{i}") for i in range(width)],
        malformed.alias(MALFORMED))


def _is_header(tokens: Sequence[str]) -> Column:
    cond = ~F.col(MALFORMED)
    for i, tok in enumerate(tokens):
        lit = F.lit(tok if tok != "" else None).cast("string")
        cond = cond & F.col(f"_c{i}").eqNullSafe(lit)
    return cond


@dataclass(frozen=True)
class Parsed:
    """Tokenised body of a delimited input: names, header tokens, rows with a flag."""

    names: list[str]
    header: list[str]
    rows: DataFrame  # value, _c0.._cN, _malformed; header lines removed

    @property
    def width(self) -> int:
        return len(self.names)


def first_file_lines(spark: SparkSession, path: str | Sequence[str],
                     encoding: str = "UTF-8") -> DataFrame:
    """The lines of the first input file in path order.  Spark orders its splits by size,
    so ``first()`` over many files could land on a headerless part file.  The first path is
    a minimum over the files' names, taken by the executors."""
    files = spark.read.format("binaryFile").load(path if isinstance(path, str) else list(path))
    first = files.agg(F.min("path")).first()[0]
    return read_lines(spark, path if first is None else first, encoding)


def parse_lines(lines: DataFrame, sep: str, accents: bool = True,
                header_source: DataFrame | None = None) -> Parsed:
    """A2-A5 on a DataFrame of lines (``value``), e.g. ``read_lines`` output or text
    that Spark derived from a table.  The first line (of ``header_source`` when given)
    is the header."""
    header = header_of(header_source if header_source is not None else lines, sep, accents)
    width = len(header)
    rows = tokenize(lines, sep, width, accents)
    rows = rows.filter(~_is_header(header))
    return Parsed(column_names(header), header, rows)


def good_rows(parsed: Parsed) -> DataFrame:
    """A5: well-formed rows as all-string columns named after the header."""
    return parsed.rows.filter(~F.col(MALFORMED)).select(
        *[F.col(f"_c{i}").alias(n) for i, n in enumerate(parsed.names)])


def malformed_rows(parsed: Parsed) -> DataFrame:
    """Rows rejected by the width check, with the raw line for inspection."""
    return parsed.rows.filter(F.col(MALFORMED)).select("value")


def profile(parsed: Parsed, name: str,
            types: Sequence[str] | Mapping[str, str] | None = None) -> DataFrame:
    """One row (file, n_cols, n_rows, n_malformed) from a single aggregate.

    Malformed rows are counted *before* the width filter (the count is meaningful).  With
    ``types`` there is one more column, ``n_bad``: for each column the number of values in
    well-formed rows that its type cannot hold."""
    counts = [
        F.lit(name).alias("file"),
        F.lit(parsed.width).cast("bigint").alias("n_cols"),
        F.count_if(~F.col(MALFORMED)).cast("bigint").alias("n_rows"),
        F.count_if(F.col(MALFORMED)).cast("bigint").alias("n_malformed"),
    ]
    if types is not None:
        bad = []
        for i, field in enumerate(_typed_fields(parsed.names, types)):
            plain = strip_quotes(F.col(f"_c{i}"))
            failed = ~F.col(MALFORMED) & plain.isNotNull() & plain.try_cast(field.dataType).isNull()
            bad.append(F.struct(F.lit(field.name).alias("column"),
                                F.count_if(failed).cast("bigint").alias("n")))
        counts.append(F.array(*bad).alias("n_bad"))
    return parsed.rows.agg(*counts)


def fault_examples(parsed: Parsed, types: Sequence[str] | Mapping[str, str] | None = None,
                   k: int = 5) -> DataFrame:
    """A6 + A7: ``(column, fault, rank, line, n)``: for every kind of fault up to ``k``
    different lines that show it, each with its number of copies.

    Faults are ``blank`` and ``width`` (column NULL) and, per column, ``type``: a value that
    the declared type cannot hold, in a line of the right width.  The lines are those with
    the smallest MD5, so any partitioning or engine names the same.  Copies of a line are
    counted map-side, and a task hands on ``k`` lines of each kind at most to the last step."""
    wide = F.when(F.length("value") == 0, "blank").otherwise("width")
    faults = [F.when(F.col(MALFORMED), F.struct(F.lit(None).cast("string").alias("column"),
                                                wide.alias("fault")))]
    for i, field in enumerate(_typed_fields(parsed.names, types)):
        plain = strip_quotes(F.col(f"_c{i}"))
        failed = ~F.col(MALFORMED) & plain.isNotNull() & plain.try_cast(field.dataType).isNull()
        faults.append(F.when(failed, F.struct(F.lit(field.name).alias("column"),
                                              F.lit("type").alias("fault"))))
    shown = parsed.rows.select("value", F.explode(F.filter(
        F.array(*faults), lambda f: f.isNotNull())).alias("f"))
    lines = shown.groupBy("f.column", "f.fault", F.col("value").alias("line")).agg(
        F.count(F.lit(1)).alias("n"))
    order = Window.partitionBy("column", "fault").orderBy(F.md5("line"))
    return lines.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "column", "fault", "rank", "line", "n")


def _typed_fields(names: Sequence[str],
                  types: Sequence[str] | Mapping[str, str] | None) -> list[T.StructField]:
    if types is None:
        words = ["str"] * len(names)
    elif isinstance(types, Mapping):
        unknown = set(types) - set(names)
        if unknown:
            raise ValueError(f"types given for unknown columns {sorted(unknown)}")
        words = [types.get(n, "str") for n in names]
    else:
        words = list(types)
    return build_schema(words, names).fields


def coerce(df: DataFrame, names: Sequence[str],
           types: Sequence[str] | Mapping[str, str] | None = None,
           on_bad: str = "null") -> DataFrame:
    """A9 + A8: NULL for empty fields, quotes stripped, then the declared types.

    ``types`` is a list of type words aligned with ``names`` or a mapping name -> word;
    omitted columns stay strings.  A value that the type cannot hold becomes NULL
    (``on_bad="null"``; :func:`profile` counts them) or fails the job (``"raise"``).
    """
    if on_bad not in ("null", "raise"):
        raise ValueError(f"on_bad is 'null' or 'raise', not {on_bad!r}")
    cols = []
    for field in _typed_fields(names, types):
        plain = strip_quotes(F.col(f"`{field.name}`"))
        c = plain
        if not isinstance(field.dataType, T.StringType):
            c = plain.try_cast(field.dataType)
            if on_bad == "raise":
                told = F.concat(F.lit(f"{field.name}: not a {field.dataType.simpleString()}: "),
                                plain)
                c = F.when(plain.isNotNull() & c.isNull(),
                           F.raise_error(told).cast(field.dataType)).otherwise(c)
        cols.append(c.alias(field.name))
    return df.select(*cols)


def load_lines_table(lines: DataFrame, sep: str,
                     types: Sequence[str] | Mapping[str, str] | None = None,
                     sample: float | None = None, seed: int | None = None,
                     accents: bool = True, header_source: DataFrame | None = None,
                     on_bad: str = "null") -> DataFrame:
    """A10 on a DataFrame of lines: header, filters, optional sample (decided by the row
    and the seed, so the same on any cluster), typed columns."""
    parsed = parse_lines(lines, sep, accents, header_source)
    body = good_rows(parsed)
    if sample is not None:
        if seed is None:
            raise ValueError("sampling needs an explicit seed")
        body = sample_rows(body, sample, seed)
    return coerce(body, parsed.names, types, on_bad)


def load_table(spark: SparkSession, path: str | Sequence[str], sep: str,
               types: Sequence[str] | Mapping[str, str] | None = None,
               sample: float | None = None, seed: int | None = None,
               accents: bool = True, encoding: str = "UTF-8", on_bad: str = "null",
               partitions: int | None = None) -> DataFrame:
    """A10: delimited file(s) -> typed DataFrame. Register it with
    ``createOrReplaceTempView`` to query it in SQL."""
    lines = read_lines(spark, path, encoding, partitions)
    return load_lines_table(lines, sep, types, sample, seed, accents,
                            first_file_lines(spark, path, encoding), on_bad)


def load_profile(spark: SparkSession, path: str | Sequence[str], sep: str,
                 name: str | None = None, accents: bool = True,
                 encoding: str = "UTF-8",
                 types: Sequence[str] | Mapping[str, str] | None = None) -> DataFrame:
    """The table profile of a delimited file."""
    lines = read_lines(spark, path, encoding)
    parsed = parse_lines(lines, sep, accents,
                         header_source=first_file_lines(spark, path, encoding))
    label = name if name is not None else (path if isinstance(path, str) else ",".join(path))
    return profile(parsed, label, types)
