from __future__ import annotations

import zlib

import corpus_pipeline
from vitrail.llm import toxicity
from vitrail.llm.common import table

from ..conftest import SF01

SF1 = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    out = toxicity.op6_toxicity(spark, SF1)
    rows = out.join(table(spark, SF1, "labels"), "doc_id").collect()
    assert out.count() == table(spark, SF1, "documents").count()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    held = [r for r in rows if r.held_out]
    toxic = [r.predicted for r in held if r.toxic]
    clean = [r.predicted for r in held if not r.toxic]
    assert sum(toxic) / len(toxic) > 0.7 and sum(clean) / len(clean) < 0.02


def test_held_out_labels_change_nothing(spark):
    docs, labels = table(spark, SF1, "documents"), table(spark, SF1, "labels")
    turned = labels.withColumn("toxic", (toxicity.is_held_out("doc_id").cast("int")
                                         .bitwiseXOR(labels["toxic"])).cast("int"))
    few = docs.where("doc_id < 3000").select("doc_id", "text")
    a = toxicity.fit(docs, labels).score(few)
    b = toxicity.fit(docs, turned.withColumn("quality", turned["toxic"])).score(few)
    assert sorted(map(tuple, a.select("doc_id", "score").collect())) == sorted(
        map(tuple, b.select("doc_id", "score").collect()))


def test_odd_rows(spark, odd_docs, no_docs):
    model = toxicity.fit(table(spark, SF1, "documents"), table(spark, SF1, "labels"))
    for docs in (odd_docs, no_docs):
        rows = model.score(docs).collect()
        assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    by_text = {r.text: r.score for r in model.score(odd_docs).collect()}
    assert by_text[None] == by_text[""]


def test_no_labels(spark, odd_docs):
    none = spark.createDataFrame([(1, 1, None)], "doc_id long, quality int, toxic int")
    rows = toxicity.fit(odd_docs, none).score(odd_docs).collect()
    assert {(r.score, r.predicted) for r in rows} == {(0.0, 0)}


def test_few_positives_still_teach(spark):
    docs, labels = table(spark, SF01, "documents"), table(spark, SF01, "labels")
    rows = toxicity.op6_toxicity(spark, SF01).where("held_out").join(labels, "doc_id").collect()
    toxic = [r.predicted for r in rows if r.toxic]
    clean = [r.predicted for r in rows if not r.toxic]
    assert sum(toxic) / len(toxic) > 0.5 and sum(clean) / len(clean) < 0.05
    left = {r.doc_id for r in corpus_pipeline.drop_toxic(spark, docs, SF01).collect()}
    gone = [r.doc_id not in left for r in rows if r.toxic]
    assert sum(gone) == sum(toxic) > 0


def test_rare_label_is_sampled_whole(spark):
    docs, labels = table(spark, SF01, "documents"), table(spark, SF01, "labels")
    few = toxicity.Settings(max_training=120)
    sample = toxicity.training_sample(docs, labels, few).groupBy("toxic").agg(
        {"*": "count", "weight": "sum"}).collect()
    n = {r["toxic"]: (r["count(1)"], r["sum(weight)"]) for r in sample}
    known = labels.where(~toxicity.is_held_out("doc_id"))
    assert n[1] == (45, 45.0) and n[0][0] == 75
    assert round(n[0][1]) == known.where("toxic = 0").count()
