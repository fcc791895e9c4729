"""Text helpers: accent stripping (B10), quote handling.

Accent stripping means: Unicode NFKD decomposition, then dropping every combining mark.
Spark SQL has no normalisation function, so texts with other than ASCII characters go
through one Arrow function made of two Arrow kernels (normalise, then delete a class of
characters); ASCII texts stay in the JVM and reach it as nulls.
"""

from __future__ import annotations

import functools
import sys
import unicodedata

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


@functools.lru_cache(maxsize=1)
def combining_marks() -> str:
    """Pattern of a run of combining marks: all code points with a combining class, as
    ranges derived from the character database."""
    ranges: list[list[int]] = []
    for cp in range(sys.maxunicode + 1):
        if unicodedata.combining(chr(cp)):
            if ranges and ranges[-1][1] == cp - 1:
                ranges[-1][1] = cp
            else:
                ranges.append([cp, cp])
    return "[" + "".join(rf"\x{{{a:x}}}-\x{{{b:x}}}" for a, b in ranges) + "]+"


def accent_folder():
    """The Arrow function; it carries its own code and pattern, so executors need not have
    this package on their path."""
    marks = combining_marks()

    def fold(texts):
        import pyarrow.compute as pc

        return pc.replace_substring_regex(pc.utf8_normalize(texts, form="NFKD"), marks, "")

    fold.__module__ = "__main__"  # pickled by value
    fold.__annotations__ = {"texts": pa.Array, "return": pa.Array}
    return F.arrow_udf(fold, "string")


def strip_accents(col: Column | str) -> Column:
    """Remove accents from a string column: NFKD without its combining marks."""
    c = F.col(col) if isinstance(col, str) else col
    ascii_only = F.octet_length(c) == F.length(c)
    return F.when(ascii_only, c).otherwise(accent_folder()(F.when(~ascii_only, c)))


def strip_quotes(col: Column | str) -> Column:
    """The loader's value coercion: a field that still reads ``""`` becomes NULL,
    any other value loses its double-quote characters (B9)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.when(c == F.lit('""'), F.lit(None).cast("string")).otherwise(
        F.replace(c, F.lit('"'), F.lit("")))
