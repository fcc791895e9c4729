"""Line dedup: lines shared by many documents stay in one of them only.

Normalised lines are exploded and hashed, the distinct documents of each hash counted, and
lines over the threshold dropped everywhere but in the largest document id that holds
them; the other lines of a text are joined again by position.  DataFrame functions only.

The exploded table carries no text: a line is its document, its position and a 128-bit
hash (two 64-bit hashes with different seeds) of its key.  Counting is map-side combined,
so the last step of counting a line that a third of all documents share gets one row per
task; the join that marks the lines can be split by adaptive execution.  Texts move once, to meet their dropped positions.

Defined cases: a null or empty text is one empty line; rows that share a ``doc_id`` are
one document when documents are counted, yet each row keeps its own text; rows with a null
``doc_id`` count as one document that is smaller than all others; a very long text is split
whole, its lines being rows of their own; other columns pass through, and the added ones replace columns of the same name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrail.llm.common import (
    GAP_CHARS,
    NO_ID,
    carried,
    packed,
    table,
    text_of,
    unpacked,
    written,
)

#: A-Z to a-z; other letters keep their case.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def line_key(line: Column) -> Column:
    """A line with the white space at both ends removed and A-Z lower-cased."""
    stripped = F.btrim(line, F.lit(GAP_CHARS))
    plain = F.length(stripped) == F.octet_length(stripped)  # ASCII: lower() does the same
    return F.when(plain, F.lower(stripped)).otherwise(F.translate(stripped, UPPER, LOWER))


def keyed_lines(docs: DataFrame, min_chars: int, doc_id: str, text: str) -> DataFrame:
    """(rid, digest, at, h1, h2): one row per line whose key is long enough; ``digest``
    tells rows with the same id apart."""
    lines = docs.select(
        F.coalesce(F.col(doc_id), F.lit(NO_ID)).cast("long").alias("rid"),
        F.xxhash64(text_of(text)).alias("digest"),
        F.posexplode(F.split(text_of(text), "\n")).alias("at", "line"))
    # a line shorter than the key's least length cannot have such a key
    keys = lines.where(F.length("line") >= min_chars).select(
        "rid", "digest", "at", line_key(F.col("line")).alias("key"))
    return keys.where(F.length("key") >= min_chars).select(
        "rid", "digest", "at", F.xxhash64("key").alias("h1"),
        F.xxhash64(F.lit("line"), "key").alias("h2"))


def shared_keys(lines: DataFrame, min_docs: int) -> DataFrame:
    """(h1, h2, keeper): keys found in at least ``min_docs`` documents."""
    return lines.groupBy("h1", "h2").agg(
        F.count_distinct("rid").alias("n"), F.max("rid").alias("keeper")
    ).where(F.col("n") >= min_docs).drop("n")


def dedup_lines(docs: DataFrame, min_chars: int = 20, min_docs: int = 3,
                doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` plus ``n_lines`` (before), ``n_dropped`` and ``kept_text``."""
    lines = written(keyed_lines(docs, min_chars, doc_id, text), "lines")
    # a table, so that both sides of the join are plain exchanges and hot keys can be split
    shared = written(shared_keys(lines, min_docs), "shared-lines")
    dropped = lines.join(shared, ["h1", "h2"]).where(F.col("rid") != F.col("keeper")).groupBy(
        "rid", "digest").agg(F.collect_set("at").alias("_dropped"))
    names = carried(docs, ["n_lines", "n_dropped", "kept_text"])
    rows = docs.select(packed(names), text_of(text).alias("_text"),
                       F.coalesce(F.col(doc_id), F.lit(NO_ID)).cast("long").alias("rid"),
                       F.xxhash64(text_of(text)).alias("digest"))
    met = rows.join(dropped, ["rid", "digest"], "left").withColumn(
        "_lines", F.split("_text", "\n"))
    left = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), F.col("_dropped"))
    joined = F.array_join(F.transform(F.sort_array(left), lambda i: F.get("_lines", i)), "\n")
    whole = F.col("_dropped").isNull()
    out = met.select("_row", F.struct(
        F.size("_lines").cast("long").alias("n_lines"),
        F.when(whole, 0).otherwise(F.size("_dropped")).cast("long").alias("n_dropped"),
        F.when(whole, F.col("_text")).otherwise(joined).alias("kept_text")).alias("_out"))
    return out.select(*unpacked(names), "_out.*")


def op2_line_dedup(spark, sf_dir: str) -> DataFrame:
    out = dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped",
                      F.sha2("kept_text", 256).alias("kept_sha256"))


OP2_SQL = r"""
WITH lines AS (
  SELECT doc_id, text, generate_subscripts(ls, 1) AS pos, unnest(ls) AS line
  FROM (SELECT doc_id, text, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents)
), keyed AS (
  SELECT doc_id, text, pos, line,
         translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines
), shared AS (
  SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT doc_id) >= 3
), marked AS (
  SELECT k.*, s.key IS NOT NULL AND k.doc_id <> s.keeper AS gone
  FROM keyed k LEFT JOIN shared s ON k.key = s.key
)
SELECT doc_id, count(*) AS n_lines, sum(gone::INT)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), ''))
         AS kept_sha256
FROM marked GROUP BY doc_id
"""
