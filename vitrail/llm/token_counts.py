"""Token counts: batch encoding inside Arrow functions that return lengths only.

Texts are gathered into batches of about equal bytes (UTF-8) and split at safe boundaries,
so that neither one long text nor many short ones decide the size of an encoder call.  A boundary
is safe where the vocabulary cannot merge across it: a space after another character, as no
piece has a space behind another character.  The parts are then encoded one by one and
equal parts only once; the lengths of parts of up to ``KNOWN_CHARS`` characters are held
until they make up ``MEMORY_BYTES`` per task.

Defined cases: a null or empty text has no tokens; a very long text is cut like others, and
one without boundaries is one part; repeated rows are counted each; other
columns pass through, and the added ones replace columns of the same name.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrail.llm.common import bounded_batches, carried, packed, table, text_of, unpacked

#: Bytes of text in one encoder call.
BATCH_BYTES = 1 << 20
#: What a task remembers: short parts, at some 100 bytes beside their characters.
KNOWN_CHARS, MEMORY_BYTES = 64, 32 << 20

#: The sign that the vocabulary writes for a space (a fixed value of the file format).
SPACE_SIGN = "▁"


def parts_of(text: str) -> list[str]:
    """The text cut at its safe boundaries.  The space at a boundary is left out: the
    encoder puts one before every part, as it does before the whole text."""
    if "  " not in text and SPACE_SIGN not in text and text[:1] != " " and text[-1:] != " ":
        return text.split(" ")
    return re.split(rf"(?s)(?<=[^ {SPACE_SIGN}]) (?=.)", text)


def check_boundaries(pieces: list[str]) -> None:
    """Raises unless no piece has a space sign behind another character."""
    odd = [p for p in pieces if SPACE_SIGN in p.lstrip(SPACE_SIGN)]
    if odd:
        raise ValueError(f"pieces merge across spaces, for instance {odd[0]!r}")


def by_bytes(texts: list[str | None], most: int = BATCH_BYTES) -> Iterator[list[str]]:
    """Runs of texts of about ``most`` bytes of UTF-8; null is empty."""
    run, held = [], 0
    for text in texts:
        run.append(text or "")
        held += len(run[-1]) if run[-1].isascii() else len(run[-1].encode("utf-8", "replace"))
        if held >= most:
            yield run
            run, held = [], 0
    if run:
        yield run


def counter(model: str):
    """An Arrow function from texts to the numbers of their tokens under the sentencepiece
    vocabulary file ``model``, which every executor can read at that path."""

    @F.arrow_udf("long")
    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        import sentencepiece

        encoder = sentencepiece.SentencePieceProcessor(model_file=model)
        check_boundaries([encoder.id_to_piece(i) for i in range(encoder.get_piece_size())])
        known: dict[str, int] = {}
        held = 0
        for batch in batches:
            lengths = []
            for run in by_bytes(batch.to_pylist()):
                parts = [parts_of(text) for text in run]
                new = list({p for each in parts for p in each}.difference(known))
                found = dict(zip(new, map(len, encoder.encode(new, num_threads=1))))
                known.update(found)
                lengths += [sum(map(known.__getitem__, each)) for each in parts]
                for part in found:
                    if len(part) > KNOWN_CHARS:
                        del known[part]
                    else:
                        held += 100 + 4 * len(part)
                if held > MEMORY_BYTES:
                    known.clear()
                    held = 0
            yield pa.array(lengths, pa.int64())

    return count


def count_tokens(docs: DataFrame, model: str, limit: int = 4096,
                 text: str = "text") -> DataFrame:
    """``docs`` plus ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit``."""
    bounded_batches(docs.sparkSession)
    names = carried(docs, ["n_bytes", "n_tokens", "over_limit"])
    rows = docs.select(packed(names), text_of(text).alias("_text"))
    rows = rows.withColumn("_n", counter(model)("_text"))
    return rows.select(*unpacked(names), F.octet_length("_text").cast("long").alias("n_bytes"),
                       F.col("_n").alias("n_tokens"), (F.col("_n") > limit).alias("over_limit"))


def op5_token_counts(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return count_tokens(table(spark, sf_dir, "documents").select("doc_id", "text"),
                        public_tokenizers.path("piece_bpe_32k.model")).drop("text")
