from __future__ import annotations

import hashlib
import math
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from vitrail.llm import mixing
from vitrail.llm.mixing import Mix
from vitrail.plans.compare import compare, duck_connection

from ..conftest import SF01


def shares(sizes, mix):
    """Targets by rounds: what lies above a cap is shared anew by weight."""
    order = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: mix.weights[i % len(mix.weights)] for i, s in enumerate(order)}
    budget = sum(sizes.values()) * mix.share[0] / mix.share[1]
    capped, target = set(), dict.fromkeys(order, 0.0)
    while True:
        rest = budget - sum(mix.epochs * sizes[s] for s in capped)
        free = [s for s in order if s not in capped]
        total = sum(weight[s] for s in free)
        target = {s: mix.epochs * sizes[s] if s in capped else rest * weight[s] / total
                  for s in order}
        above = {s for s in free if target[s] > mix.epochs * sizes[s]}
        if not above:
            return target
        capped |= above


def brute(rows, mix):
    """(doc_id, source, size) -> times it is taken, by sorting each source."""
    sizes = defaultdict(int)
    for _, s, size, _ in rows:
        sizes[s] += size
    target, times = shares(sizes, mix), {}
    for source in sizes:
        full = math.floor(target[source] / sizes[source]) if sizes[source] else 0
        budget, before = target[source] - full * sizes[source], 0

        def key(r):
            h = int(hashlib.md5(f"{r[0]}|{mix.seed}".encode()).hexdigest()[:12], 16)
            return -math.log((h + 0.5) / 2 ** 48) / max(r[3], 1e-6), str(r[0]), r[2]

        for r in sorted((r for r in rows if r[1] == source), key=key):
            part = r[2] > 0 and 2 * before + r[2] <= 2 * budget
            times[r[0]] = (full + part) if r[2] else 0
            before += r[2]
    return target, times


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, source string, size long, quality double")


def test_query_equals_sql(spark):
    got = mixing.op13_mix_sources(spark, SF01)
    rel = duck_connection(SF01).sql(mixing.OP13_SQL)
    assert compare(got.columns, [tuple(r) for r in got.collect()], rel.columns,
                   rel.fetchall()) is None


@pytest.mark.parametrize("mix", [Mix(), Mix(weights=(1,), share=(1, 1)),
                                 Mix(weights=(9, 1), share=(5, 2), epochs=3, seed=1)])
def test_against_brute_force(spark, mix):
    rows = [(i, [*"abcdefg", None][(i * i) % 8] if i % 3 else "hot", (i * 37) % 90, 0.1 + i % 4)
            for i in range(900)]
    target, times = brute(rows, mix)
    got = mixing.mixed(frame(spark, rows).repartition(11), mix).collect()
    assert {r.doc_id: r.epochs for r in got} == times
    for r in got:
        assert r.target == pytest.approx(target[r.source], rel=1e-12)
        assert r.taken == r.epochs * r.size <= mix.epochs * r.size


def test_targets_are_met_and_epochs_are_complete(spark):
    rows = [(i, f"s{i % 5}", 1 + i % 50, 1.0) for i in range(2000)]
    got = mixing.mixed(frame(spark, rows)).collect()
    by = defaultdict(list)
    for r in got:
        by[r.source].append(r)
    for docs in by.values():
        taken, size, target = sum(r.taken for r in docs), docs[0].source_size, docs[0].target
        assert abs(taken - target) <= 25.5  # half of the longest document
        full = math.floor(target / size)
        assert {r.epochs for r in docs} <= {full, full + 1}


def test_quality_is_sampled_more_often(spark):
    # one source whose half is taken: documents of four times the quality, more of them
    rows = [(i, "s", 10, 4.0 if i % 2 else 1.0) for i in range(4000)]
    got = mixing.mixed(frame(spark, rows), Mix(weights=(1,), share=(1, 2))).collect()
    share = [sum(r.epochs for r in got if r.doc_id % 2 == k) / 2000 for k in (0, 1)]
    # both exponential in one threshold t: 1 - exp(-t) and 1 - exp(-4 t) add up to 1
    assert abs(share[0] - 0.276) < 0.03 and abs(share[1] - 0.724) < 0.03


def test_reruns_and_partitions_agree(spark):
    docs = frame(spark, [(i, "x" if i % 3 else "y", i % 40, 0.5) for i in range(600)])
    one, two = (sorted(map(tuple, mixing.mixed(d).collect())) for d in (docs, docs.repartition(7)))
    assert one == two


def test_odd_rows(spark, odd_docs, no_docs):
    got = mixing.mixed(mixing.measured(odd_docs)).collect()
    assert len(got) == odd_docs.count()
    for r in got:
        assert r.size == len((r.text or "").split()) or "\x01" in (r.text or "")
        assert r.kept == 7 or r.doc_id is None
        assert 0 <= r.taken <= 2 * r.size
    total = sum(r.size for r in got)
    assert abs(sum(r.taken for r in got) - 1.5 * total) <= 1500.5 * 2
    assert mixing.mixed(mixing.measured(no_docs)).count() == 0
    empty = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string").withColumn(
        "source", F.lit(None).cast("string"))
    rows = mixing.mixed(mixing.measured(empty)).collect()
    assert [(r.size, r.source_size, r.target, r.taken) for r in rows] == [(0, 0, 0.0, 0)] * 2


def test_clashing_names_bad_qualities_and_the_mix_itself(spark):
    rows = [(1, "a", 4, None, "keep", "b"), (2, "a", 4, -1.0, "keep", "b"), (3, "a", 4, 2.0, "k", "b")]
    docs = spark.createDataFrame(
        rows, "doc_id long, source string, size long, quality double, key string, before string")
    docs = docs.withColumn("taken", F.lit("old")).withColumn("name", F.lit(1))
    out = mixing.mixed(docs)
    assert out.columns == ["doc_id", "source", "quality", "key", "before", "name", "size",
                           "source_size", "target", "epochs", "taken"]
    assert sum(r.taken for r in out.collect()) in (16, 20)  # 18 words, to half a document
    mix = mixing.repeated(out)
    assert mix.count() == sum(r.epochs for r in out.collect())
    assert {(r.epoch < r.epochs) for r in mix.collect()} == {True}
