from __future__ import annotations

import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from vitrail.llm import quality
from vitrail.llm.common import table

from ..conftest import SF01

SF1 = "/root/testdata/sf0.1"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    text = text or ""
    w = WORD.findall(text)
    seen = Counter(zip(w, w[1:], w[2:]))
    covered = set()
    for i in range(len(w) - 2):
        if seen[(w[i], w[i + 1], w[i + 2])] > 1:
            covered |= {i, i + 1, i + 2}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text),
            len(lines) - len(set(lines)), len(covered),
            len(w) < 50 or 100 * len(covered) > 50 * len(w))


def test_base_measures_brute_force(spark):
    texts = {r.doc_id: r.text for r in table(spark, SF01, "documents").collect()}
    rows = quality.op1_quality(spark, SF01).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words,
                r.base_failed) == base(texts[r.doc_id])
        assert not (r.base_failed and r.kept)


def test_kept_follows_the_quality_labels(spark):
    labels = table(spark, SF01, "labels")
    rows = quality.op1_quality(spark, SF01).where("not base_failed").join(labels, "doc_id")
    n = {(r.quality, r.kept): r["count"] for r in rows.groupBy("quality", "kept").count().collect()}
    good, bad = n.get((1, True), 0), n.get((0, False), 0)
    assert good / (good + n.get((1, False), 0)) > 0.98
    assert bad / (bad + n.get((0, True), 0)) > 0.5


def test_js_distance(spark):
    p, q = [0.5, 0.5, 0.0], [0.25, 0.25, 0.5]
    row = spark.createDataFrame([(p,)], "p array<double>").select(
        quality.js_distance("p", q).alias("d"), quality.js_distance("p", p).alias("z")).first()
    m = [(a + b) / 2 for a, b in zip(p, q)]
    kl = lambda x: sum(a * math.log2(a / b) for a, b in zip(x, m) if a)
    assert row.d == pytest.approx(math.sqrt((kl(p) + kl(q)) / 2)) and row.z == 0


def test_odd_rows(odd_docs, no_docs):
    rows = quality.judge(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    for r in rows:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words,
                r.base_failed) == base(r.text)
        assert isinstance(r.kept, bool)  # replaces the input's column of that name
    assert quality.judge(no_docs).count() == 0


def test_filter_is_not_pushed_into_the_measures(spark):
    docs = table(spark, SF01, "documents")
    plan = quality.judge(docs).where("kept")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Generate explode") >= 2 and "Python" not in plan
    assert quality.judge(docs).where(~F.col("kept")).count() > 0


def test_rejection_and_clean_loss_by_length(spark):
    rows = quality.op1_quality(spark, SF1).where("not base_failed").join(
        table(spark, SF1, "labels"), "doc_id").collect()
    for low, high, found, lost in ((50, 100, 0.9, 0.035), (100, 200, 0.97, 0.015),
                                   (200, math.inf, 0.99, 0.002)):
        band = [r for r in rows if low <= r.n_words < high]
        bad = [not r.kept for r in band if r.quality == 0]
        good = [not r.kept for r in band if r.quality == 1]
        report = f"{low}: {sum(bad)} of {len(bad)} bad, {sum(good)} of {len(good)} good rejected"
        print(report)
        assert sum(bad) >= found * len(bad) and sum(good) <= lost * len(good), report


def test_languages_without_a_reference_keep_their_good_documents(spark):
    docs = table(spark, SF01, "documents")
    good = docs.join(table(spark, SF01, "labels").where("quality = 1"), "doc_id")
    spanish = good.where("lang = 'es'").select(docs.columns)
    few = spanish.limit(quality.PRODUCTION.min_reference - 1)
    others = docs.where("lang <> 'es'")
    words = "kato hundo domo arbo libro vojo tago nokto suno luno akvo fajro".split()
    odd = [(-i, " ".join(words[(j * j + j) % 12] + "aeiou"[j % 5] * (j % 7)
                         + (". Kaj" if j % 9 == 0 else "") for j in range(300)), lang) for i, lang in ((1, "eo"), (5, None))]
    arabic = "".join(chr(0x627 + i) for i in range(20))
    odd += [(-9, " ".join(arabic[j % 17:j % 17 + 2 + j % 5] + arabic[j * j % 19]
                          for j in range(300)), "ar")]
    new = spark.createDataFrame([(i, x, l, "s", len(x)) for i, x, l in odd],
                                others.schema)
    rows = quality.judge(others.union(few).union(new)).where(
        "(lang = 'es' or doc_id < 0) and not base_failed").collect()
    assert {r.doc_id for r in rows} >= {-1, -5, -9} and any(r.lang == "es" for r in rows)
    assert [r.doc_id for r in rows if r.n_words >= 200 and not r.kept] == []


def test_junk_without_a_reference_is_still_rejected(spark):
    docs = table(spark, SF01, "documents")
    junk = " ".join(f"#{i}$%" + "&|<>"[i % 4] * (i % 7) for i in range(300))
    new = spark.createDataFrame([(-1, junk, "eo", "s", len(junk))], docs.schema)
    row = quality.judge(docs.union(new)).where("doc_id = -1").first()
    assert not row.base_failed and not row.kept
