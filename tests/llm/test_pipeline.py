from __future__ import annotations

import random

from pyspark.sql import functions as F

import corpus_pipeline
from vitrail.llm import jaccard_join, line_dedup, packing, quality, toxicity
from vitrail.llm.common import table, written
from vitrail.llm.queries import oracle_sql, registry

from ..conftest import SF001, SF01


def test_stages_take_effect(spark):
    docs = table(spark, SF01, "documents")
    columns = docs.columns
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        seen[name] = docs = written(stage(spark, docs, SF01), f"test-{name}")
        if name != "packing":
            assert docs.columns == columns
    first = {r.doc_id: r.text for r in table(spark, SF01, "documents").collect()}
    clean = {r.doc_id for r in seen["toxicity"].collect()}
    model = toxicity.fit(table(spark, SF01, "documents"), table(spark, SF01, "labels"))
    judged = model.score(table(spark, SF01, "documents"))
    assert clean == {r.doc_id for r in judged.where("predicted = 0").collect()}
    good = quality.judge(seen["toxicity"]).where("kept")
    assert {r.doc_id for r in seen["quality"].collect()} == {r.doc_id for r in good.collect()}
    lines = {r.doc_id: r for r in seen["line_dedup"].collect()}
    assert len(lines) == seen["quality"].count()
    assert all(r.n_chars == len(r.text) for r in lines.values())
    assert any(r.text != first[r.doc_id] for r in lines.values())
    again = line_dedup.dedup_lines(seen["line_dedup"]).agg(F.sum("n_dropped")).first()[0]
    assert again == 0
    kept = {r.doc_id for r in seen["near_duplicates"].collect()}
    groups = jaccard_join.similar_groups(seen["line_dedup"], corpus_pipeline.NEAR).collect()
    assert kept == {r.component_id for r in groups} and len(kept) < len(lines)
    packed = seen["packing"].collect()
    assert {r.doc_id for r in packed} == kept
    assert corpus_pipeline.run(spark, SF01).count() == len(packed)


def test_registry(spark):
    numbers = sorted(int(name[2:].split("_")[0]) for name in registry())
    assert numbers == list(range(1, 14)) and set(oracle_sql()) <= set(registry())
    out = packing.op7_best_fit_packing(spark, SF001)
    assert out.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id",
                           "offset"]


def corpus(spark, folder, docs, labels):
    kinds = ("doc_id long, text string, lang string, source string, n_chars long",
             "doc_id long, quality int, toxic int")
    for name, rows, kind in zip(("documents", "labels"), (docs, labels), kinds):
        spark.createDataFrame(rows, kind).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def prose(seed, n=120):
    rnd = random.Random(seed)
    return " ".join(rnd.choice(["the", "of", "and"]) if k % 3 == 0 else "".join(
        rnd.choice("abdeilmnorst") for _ in range(rnd.randint(3, 8))) for k in range(n))


def test_odd_rows_of_a_corpus(spark, tmp_path):
    docs = [(i, prose(i), "en", "s", 1) for i in range(8)]
    docs += [docs[0], docs[0],                       # repeated rows
             (1, prose(100), "en", "s", 1),          # an id with two texts
             (None, prose(101), None, None, None), (50, None, "en", "s", None),
             (51, "", "en", "s", 0), (None, None, None, None, None),
             (52, prose(7) + " end", "xx", "s", 1)]  # a near copy of 7
    path = corpus(spark, tmp_path, docs, [(1, 1, None), (None, None, 1)])
    rows = corpus_pipeline.run(spark, path).collect()
    pieces = sorted((r.doc_id for r in rows), key=str)
    assert pieces == sorted([0, 1, 1, 2, 3, 4, 5, 6, 7, None], key=str)


def test_empty_corpora(spark, tmp_path):
    assert corpus_pipeline.run(spark, corpus(spark, tmp_path / "a", [], [])).count() == 0
    short = [(i, "too short", "en", "s", 9) for i in range(5)]
    assert corpus_pipeline.run(spark, corpus(spark, tmp_path / "b", short, [(0, 1, 0)])).count() == 0
