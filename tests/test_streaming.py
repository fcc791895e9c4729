"""The ingest parser on a file stream gives the same rows and counts as the batch path."""

from __future__ import annotations

from vitrail.sources import delimited
from vitrail.streaming import ingest


def test_stream_matches_batch(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    (src / "a.csv").write_text("a;b\n1;x\n2\n", encoding="utf-8")
    (src / "b.csv").write_text('a;b\n3;"é"\n\n4;y;z\n', encoding="utf-8")

    lines = ingest.read_text_stream(spark, str(src), max_files_per_trigger=1)
    parsed = ingest.parse_stream(lines, ";", ["a", "b"])
    rows_q = ingest.start(ingest.typed_stream(parsed, ["bin", "str"]), str(tmp_path / "c1"), sink="memory",
                          query_name="stream_rows", available_now=True)
    prof_q = ingest.start(ingest.profile_stream(parsed, "in"), str(tmp_path / "c2"), sink="memory",
                          output_mode="complete", query_name="stream_profile",
                          available_now=True)
    rows_q.awaitTermination(120)
    prof_q.awaitTermination(120)
    got = sorted(tuple(r) for r in spark.sql("SELECT * FROM stream_rows").collect())
    batch = delimited.load_table(spark, str(src), ";", types=["bin", "str"])
    assert got == sorted(tuple(r) for r in batch.collect()) == [(1, "x"), (3, "e")]
    prof = spark.sql("SELECT * FROM stream_profile").collect()[-1]
    assert (prof.n_rows, prof.n_malformed) == (2, 3)


def test_fitted_pipeline_scores_a_stream(spark, tmp_path):
    from vitrail.operators import models

    rows = [(float(1 + i % 2), float(i % 2) * 4 + 0.5, 1.0) for i in range(40)]
    train = spark.createDataFrame(rows, "label double, a double, b double")
    clf = models.fit_classifier(train, models.decision_tree("entropy", 3, 32), "label", ["a", "b"])

    src = tmp_path / "score"
    src.mkdir()
    (src / "x.csv").write_text("a;b\n0.5;1\n4.5;1\n", encoding="utf-8")
    parsed = ingest.parse_stream(ingest.read_text_stream(spark, str(src)), ";", ["a", "b"])
    typed = ingest.typed_stream(parsed).selectExpr("CAST(a AS DOUBLE) AS a", "CAST(b AS DOUBLE) AS b")
    q = ingest.start(clf.transform(typed).select("a", "prediction"), str(tmp_path / "c"), sink="memory",
                     query_name="stream_scores", available_now=True)
    q.awaitTermination(120)
    got = sorted(tuple(r) for r in spark.sql("SELECT * FROM stream_scores").collect())
    assert got == [(0.5, 1.0), (4.5, 2.0)]


def test_a_restarted_stream_goes_on_where_it_stopped(spark, tmp_path):
    src, out, ckpt = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "ckpt")
    src.mkdir()

    def run():
        parsed = ingest.parse_stream(ingest.read_text_stream(spark, str(src)), ";", ["a", "b"])
        ingest.start(ingest.typed_stream(parsed), ckpt, path=out,
                     available_now=True).awaitTermination(120)

    (src / "1.csv").write_text("a;b\n1;x\n", encoding="utf-8")
    run()
    (src / "2.csv").write_text("a;b\n2;y\n", encoding="utf-8")
    run()
    assert sorted(r.a for r in spark.read.parquet(out).collect()) == ["1", "2"]
