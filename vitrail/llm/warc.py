"""WARC archives: writing with revisits, indexing first, then byte-range reads.

Writing: pages with equal payloads (by SHA-256) of at least ``min_revisit`` bytes are stored
once, as the response of the smallest page id; the others become revisit records that refer
to it.  Every task writes gzip members, one per record, to archives of its own below a
shared folder, and starts a new archive at ``ARCHIVE_BYTES``; the names hold the task
attempt, so a repeated task never touches the files of another, and only those listed in
the manifest count.

Reading: the index has offset, length, URL and digest per record.  Selected records are
dealt by archive and byte block, sorted by offset, and neighbouring ranges are read with
one request.

Defined cases: a null html is an empty payload, a null url leaves the header out; rows with
a null page id are written under an empty id and never are the response that others refer
to, unless no other has one; rows that share a page id and a payload are of one type;
control characters and spaces in URLs are percent-encoded; a very long payload is one
record, which a task holds whole; extra columns are not read; an empty table gives no
records.
"""

from __future__ import annotations

import gzip
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrail.llm.common import remember, table, text_of, written
from vitrail.session import scratch_path

ARCHIVE_BYTES = 64 << 20
#: Byte ranges: block that decides which task reads a record, largest request, and the gap
#: between two records up to which one request fetches both.
BLOCK_BYTES, REQUEST_BYTES, GAP_BYTES = 8 << 20, 8 << 20, 64 << 10

#: Fixed values of the format.
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ID_PREFIX = "urn:page:"

INDEX = ("file string, offset long, length long, record_type string, record_id string, "
         "url string, digest string, refers_to string, payload_length long")
RECORD = INDEX + ", payload binary"


#: Schemes of Hadoop's connectors and the names of the same stores here (fixed values).
SCHEMES = {"s3a": "s3", "s3n": "s3", "gcs": "gs"}


def shared_store(uri: str):
    """The file system and path of a folder that driver and executors share.  Archives are
    byte streams that rows point into, which Spark's sources can't write, so they go through
    pyarrow's file systems: local and mounted paths, ``s3`` (also as ``s3a``), ``gs``,
    ``abfs(s)`` and, where every executor has libhdfs, ``hdfs`` and ``viewfs``.  Any other
    scheme raises before anything is written."""
    from pyarrow import fs

    if "://" not in uri:
        uri = "file://" + re.sub(r"^file:", "", uri)
    scheme, rest = uri.split("://", 1)
    try:
        return fs.FileSystem.from_uri(f"{SCHEMES.get(scheme, scheme)}://{rest}")
    except pa.ArrowInvalid as unknown:
        raise ValueError(f"archives can't be kept under {scheme}://; set spark.checkpoint.dir "
                         "to a path, s3a, gs, abfs or hdfs") from unknown


# ------------------------------------------------------------------ writing

def record_types(pages: DataFrame, min_revisit: int = 100) -> DataFrame:
    """(page_id, url, payload, digest, first): ``first`` is the page whose response a
    revisit refers to, null for responses."""
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), "url",
        text_of("html").cast("binary").alias("payload")).withColumn(
        "digest", F.sha2("payload", 256))
    firsts = pages.select(F.col("page_id").cast("long").alias("page_id"),
                          text_of("html").cast("binary").alias("payload")).where(
        F.octet_length("payload") >= min_revisit).groupBy(
        F.sha2("payload", 256).alias("digest")).agg(F.min("page_id").alias("_first"))
    first = F.when(F.col("page_id").isNull() | (F.col("page_id") != F.col("_first")),
                   F.col("_first"))
    return rows.join(firsts, "digest", "left").select(
        "page_id", "url", "payload", "digest", first.alias("first"))


def record_bytes(page_id, url, payload: bytes, digest: str, first, date: str) -> bytes:
    """One record, uncompressed."""
    head = ["WARC/1.1", f"WARC-Type: {'response' if first is None else 'revisit'}",
            f"WARC-Record-ID: <{ID_PREFIX}{'' if page_id is None else page_id}>",
            f"WARC-Date: {date}", f"WARC-Payload-Digest: sha256:{digest}",
            f"X-Payload-Length: {len(payload)}"]
    if url is not None:
        clean = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)
        head.append(f"WARC-Target-URI: {clean}")
    block = b""
    if first is None:
        head.append("Content-Type: application/http;msgtype=response")
        block = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
                 + f"Content-Length: {len(payload)}\r\n\r\n".encode() + payload)
    else:
        head += [f"WARC-Refers-To: <{ID_PREFIX}{first}>", f"WARC-Profile: {REVISIT_PROFILE}"]
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def write_archives(typed: DataFrame, folder: str, date: str = "2024-01-01T00:00:00Z",
                   archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Writes the rows of :func:`record_types`; the manifest (file, n_records, n_bytes) is
    a written table, so no archive is written twice."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get()
        stem = f"part-{task.partitionId():06d}-{task.taskAttemptId()}"
        store, base = shared_store(folder)
        made, out, n, size = [], None, 0, 0
        for batch in batches:
            for page_id, url, payload, digest, first in zip(*(c for c in batch.columns)):
                if out is None:
                    store.create_dir(base, recursive=True)
                    name = f"{stem}-{len(made)}.warc.gz"
                    out, n, size = store.open_output_stream(f"{base}/{name}",
                                                            compression=None), 0, 0
                member = gzip.compress(record_bytes(
                    page_id.as_py(), url.as_py(), payload.as_py(), digest.as_py(),
                    first.as_py(), date), 6, mtime=0)
                out.write(member)
                n, size = n + 1, size + len(member)
                if size >= archive_bytes:
                    out.close()
                    made.append((name, n, size))
                    out = None
        if out is not None:
            out.close()
            made.append((name, n, size))
        yield pa.RecordBatch.from_arrays(
            [pa.array([m[0] for m in made], pa.string()), pa.array([m[1] for m in made], pa.int64()),
             pa.array([m[2] for m in made], pa.int64())], ["file", "n_records", "n_bytes"])

    return written(typed.select("page_id", "url", "payload", "digest", "first").mapInArrow(
        write, "file string, n_records long, n_bytes long"), "warc-manifest")


# ------------------------------------------------------------------ reading

def parse_head(record: bytes) -> tuple[dict[str, str], int]:
    """The header fields of an uncompressed record, and where its block starts."""
    end = record.index(b"\r\n\r\n")
    lines = record[:end].decode().split("\r\n")
    return dict(line.split(": ", 1) for line in lines[1:]), end + 4


def index_entry(file: str, offset: int, length: int, head: dict[str, str]) -> tuple:
    return (file, offset, length, head["WARC-Type"], head["WARC-Record-ID"].strip("<>"),
            head.get("WARC-Target-URI"), head["WARC-Payload-Digest"].removeprefix("sha256:"),
            head.get("WARC-Refers-To", "").strip("<>") or None,
            int(head.get("X-Payload-Length", -1)))


def batch_of(rows: list[tuple], payload: bool = False) -> pa.RecordBatch:
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(),
             pa.string(), pa.string(), pa.int64()] + [pa.binary()] * payload
    names = [c.split()[0] for c in (RECORD if payload else INDEX).split(", ")]
    columns = list(zip(*rows)) or [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)


def index_archives(files: DataFrame, folder: str) -> DataFrame:
    """The index of the archives named in column ``file``, read member by member."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = shared_store(folder)
        for batch in batches:
            for file in batch.column(0).to_pylist():
                rows = []
                with store.open_input_stream(f"{base}/{file}", compression=None) as stream:
                    offset, held = 0, b""
                    while held or (held := stream.read(1 << 20)):
                        member, head, size = zlib.decompressobj(31), b"", 0
                        while True:
                            text = member.decompress(held)
                            if b"\r\n\r\n" not in head:  # the header is all that is kept
                                head += text
                            size += len(held) - len(member.unused_data)
                            held = member.unused_data
                            if member.eof or not (held := stream.read(1 << 20)):
                                break
                        if not member.eof:
                            raise ValueError(f"{file} ends inside the record at {offset}")
                        rows.append(index_entry(file, offset, size, parse_head(head)[0]))
                        offset += size
                        if len(rows) >= 5000:
                            yield batch_of(rows)
                            rows = []
                yield batch_of(rows)

    n = int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # an archive is a task's work; by number, as the names alone would be put together
    return files.select("file").repartition(n).mapInArrow(scan, INDEX)


def read_records(index: DataFrame, folder: str) -> DataFrame:
    """The records of the selected index rows, with payloads (null for revisits)."""

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = shared_store(folder)
        source, opened = None, None

        def read(file: str, run: list[tuple[int, int]]) -> Iterator[tuple]:
            nonlocal source, opened
            if opened != file:
                if source is not None:
                    source.close()
                source, opened = store.open_input_file(f"{base}/{file}"), file
            start, end = run[0][0], run[-1][0] + run[-1][1]
            source.seek(start)
            data = source.read(end - start)
            for offset, length in run:
                record = gzip.decompress(data[offset - start:offset - start + length])
                head, at = parse_head(record)
                block = record[at:at + int(head["Content-Length"])]
                body = None
                if head["WARC-Type"] == "response":
                    body = block[block.index(b"\r\n\r\n") + 4:]
                yield (*index_entry(file, offset, length, head), body)

        file, run, rows, held = None, [], [], 0
        for batch in batches:
            for name, offset, length in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if run and (name != file or offset - sum(run[-1]) > GAP_BYTES
                            or offset + length - run[0][0] > REQUEST_BYTES):
                    rows += read(file, run)
                    run = []
                    if sum(len(r[-1] or b"") for r in rows) > REQUEST_BYTES or len(rows) > 5000:
                        yield batch_of(rows, True)
                        rows = []
                file = name
                run.append((offset, length))
        if run:
            rows += read(file, run)
        yield batch_of(rows, True)

    n = int(index.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = index.select("file", "offset", "length").repartition(
        n, "file", F.floor(F.col("offset") / BLOCK_BYTES))
    return dealt.sortWithinPartitions("file", "offset").mapInArrow(fetch, RECORD)


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "warc")
    remember(spark, folder)
    manifest = write_archives(record_types(table(spark, sf_dir, "pages")), folder)
    index = written(index_archives(manifest, folder), "warc-index")
    records = read_records(index, folder)

    def page(column: str):
        return F.expr(f"try_cast(substr({column}, {len(ID_PREFIX) + 1}) as bigint)")

    full = F.col("record_type") == "response"
    return records.select(
        page("record_id").alias("page_id"),
        F.when(full, F.octet_length("payload").cast("long")).otherwise(
            F.col("payload_length")).alias("payload_bytes"),
        F.when(full, F.sha2("payload", 256)).otherwise(F.col("digest")).alias("payload_digest"),
        "record_type", page("refers_to").alias("refers_to"))


OP4_SQL = r"""
WITH rows_ AS (
  SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes,
         sha256(coalesce(html, '')) AS payload_digest FROM pages
), firsts AS (
  SELECT payload_digest, min(page_id) AS first FROM rows_ WHERE payload_bytes >= 100
  GROUP BY payload_digest
)
SELECT r.page_id, r.payload_bytes, r.payload_digest,
       CASE WHEN f.first IS NULL OR f.first = r.page_id THEN 'response' ELSE 'revisit' END
         AS record_type,
       CASE WHEN f.first <> r.page_id THEN f.first END AS refers_to
FROM rows_ r LEFT JOIN firsts f ON r.payload_digest = f.payload_digest
"""
