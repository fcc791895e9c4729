from __future__ import annotations

import hashlib

from vitrail.llm import warc
from vitrail.plans.compare import compare, duck_connection
from vitrail.session import scratch_path

from ..conftest import SF001


def test_oracle(spark):
    df = warc.op4_warc(spark, SF001)
    rel = duck_connection(SF001).sql(warc.OP4_SQL)
    assert compare(df.columns, [tuple(r) for r in df.collect()], rel.columns,
                   rel.fetchall()) is None


BIG = "<p>café</p>\r\n\r\n" * 40


def round_trip(spark, pages, archive_bytes=1 << 20):
    folder = scratch_path(spark, "warc-test")
    manifest = warc.write_archives(warc.record_types(pages), folder, archive_bytes=archive_bytes)
    index = warc.index_archives(manifest, folder)
    return manifest, index, folder


def test_revisits_nulls_and_repeats(spark):
    pages = spark.createDataFrame(
        [(5, "http://a/", BIG), (3, "http://b/ x\r\n", BIG), (3, "http://b/", BIG),
         (9, None, BIG), (1, "u", "small"), (2, "u", "small"), (4, "u", None), (6, "u", ""),
         (None, "u", BIG), (7, "u", "z" * 300_000)],
        "page_id long, url string, html string").withColumn("digest", warc.F.lit("clash"))
    manifest, index, folder = round_trip(spark, pages, 2000)
    assert sum(r.n_records for r in manifest.collect()) == 10
    rows = warc.read_records(index, folder).collect()
    kinds = sorted((r.record_id.removeprefix(warc.ID_PREFIX), r.record_type,
                    (r.refers_to or "").removeprefix(warc.ID_PREFIX)) for r in rows)
    assert kinds == [("", "revisit", "3"), ("1", "response", ""), ("2", "response", ""),
                     ("3", "response", ""), ("3", "response", ""), ("4", "response", ""),
                     ("5", "revisit", "3"), ("6", "response", ""), ("7", "response", ""),
                     ("9", "revisit", "3")]
    for r in rows:
        if r.payload is not None:
            assert hashlib.sha256(bytes(r.payload)).hexdigest() == r.digest
            assert len(r.payload) == r.payload_length
    assert {r.url for r in rows if r.record_id.endswith(":3")} == {
        "http://b/%20x%0D%0A", "http://b/"}


def test_selected_records_only(spark):
    pages = spark.createDataFrame([(i, f"u{i}", f"{i}" * 500) for i in range(50)],
                                  "page_id long, url string, html string")
    _, index, folder = round_trip(spark, pages, 3000)
    some = index.where("url in ('u3', 'u4', 'u40')")
    rows = warc.read_records(some, folder).collect()
    assert {(r.url, bytes(r.payload)) for r in rows} == {
        (f"u{i}", (f"{i}" * 500).encode()) for i in (3, 4, 40)}


def test_no_pages(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    _, index, folder = round_trip(spark, pages)
    assert index.count() == 0 and warc.read_records(index, folder).count() == 0
