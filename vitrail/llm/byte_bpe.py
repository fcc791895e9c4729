"""Byte-level BPE encoding and decoding by a local rank file, with the tiktoken library.

Long texts are pre-split at safe boundaries, places where no match of the splitting pattern
can go on: before a space or line feed that follows a printable ASCII character.  Ids go
back to raw bytes, which need not be UTF-8 when ids are cut.

Defined cases: a null or empty text has no ids, null ids decode to no bytes; repeated rows
are encoded each; other columns pass through, and the added ones replace columns of the
same name.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrail.llm.common import bounded_batches, carried, packed, table, text_of, unpacked

#: Characters from which on a text is pre-split, and of each part about.
PART_CHARS = 1 << 16


def parts_of(text: str, most: int = PART_CHARS) -> Iterator[str]:
    """The text in parts of about ``most`` characters, cut at safe boundaries only."""
    start = 0
    safe = re.compile(r"(?<=[!-~])[ \n]")
    while len(text) - start > most:
        cut = safe.search(text, start + most)
        if cut is None:
            break
        yield text[start:cut.start()]
        start = cut.start()
    yield text[start:] if start else text


def rank_encoder(ranks: str, pattern: str, special: dict[str, int] | None = None):
    """The library's encoder over the rank file at path ``ranks``."""
    import base64

    import tiktoken

    with open(ranks, "rb") as lines:
        table_ = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table_,
                             special_tokens=special or {})


def encoder(ranks: str, pattern: str):
    """An Arrow function from texts to arrays of ids; strings of special tokens are text."""

    @F.arrow_udf("array<int>")
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = rank_encoder(ranks, pattern)
        for batch in batches:
            found, sizes = [], [0]
            for text in batch:  # lists of ids are large: they turn into arrays part by part
                parts = [np.array(own.encode_ordinary(part), dtype=np.int32)
                         for part in parts_of(text.as_py() or "")]
                found += parts
                sizes.append(sizes[-1] + sum(map(len, parts)))
            ids = np.concatenate(found) if found else np.empty(0, np.int32)
            yield pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), pa.array(ids))

    return encode


def decoder(ranks: str, pattern: str):
    """An Arrow function from arrays of ids to raw bytes."""

    @F.arrow_udf("binary")
    def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = rank_encoder(ranks, pattern)
        for batch in batches:
            yield pa.array([own.decode_bytes(ids.as_py() or []) for ids in batch], pa.binary())

    return decode


def encode_texts(docs: DataFrame, ranks: str, pattern: str, text: str = "text") -> DataFrame:
    """``docs`` plus ``ids``."""
    bounded_batches(docs.sparkSession)
    names = carried(docs, ["ids"])
    rows = docs.select(packed(names), encoder(ranks, pattern)(text_of(text)).alias("_ids"))
    return rows.select(*unpacked(names), F.col("_ids").alias("ids"))


def decode_ids(ids: Column, ranks: str, pattern: str) -> Column:
    """The bytes that an array of ids stands for."""
    return decoder(ranks, pattern)(F.coalesce(ids, F.array().cast("array<int>")))


def op8_byte_bpe(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    ranks, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = encode_texts(docs, ranks, pattern).select(
        "doc_id", "ids", decode_ids(F.col("ids"), ranks, pattern).alias("raw"))
    return out.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256)
         .alias("ids_sha256"), F.sha2("raw", 256).alias("decoded_sha256"))
