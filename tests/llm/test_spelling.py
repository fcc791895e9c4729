from __future__ import annotations

import random
import re
import zlib
from collections import Counter, defaultdict
from dataclasses import replace

import pytest

from vitrail.llm import spelling
from vitrail.llm.spelling import Bounds, Grouping, scan
from vitrail.plans.compare import compare, duck_connection

from ..conftest import SF01

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(counts, ratio=5):
    form, out = {}, {}
    for w, n in counts.items():
        around = [v for v in counts if near(w, v)]
        best = min(around, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= ratio * n else None
        out[w] = len(around)
    rows = []
    for w, n in counts.items():
        root = w
        while form[root]:
            root = form[root]
        rows.append((w, form[w], root, n, out[w], counts[form[w]] if form[w] else None))
    return sorted(rows)


def grouped(spark, counts, g=Grouping()):
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    return sorted(map(tuple, spelling.variants(df, g).collect()))


def test_query_equals_sql(spark):
    got = spelling.op12_spelling_variants(spark, SF01)
    rel = duck_connection(SF01).sql(spelling.OP12_SQL)
    assert compare(got.columns, [tuple(r) for r in got.collect()], rel.columns,
                   rel.fetchall()) is None


@pytest.mark.parametrize("range_words, ranges", [(20_000, 10_000), (7, 10_000), (7, 5)])
def test_dense_vocabulary_against_brute_force(spark, range_words, ranges):
    rnd = random.Random(1)
    # few letters: words with many neighbours, letters in a row, and equal counts
    words = {"".join(rnd.choice("aab") for _ in range(rnd.randint(3, 7))) for _ in range(160)}
    words |= {"".join(rnd.choice("xyÿé") for _ in range(4)) for _ in range(40)}
    counts = {w: rnd.choice([5, 5, 6, 26, 140, 900, 7000]) for w in sorted(words)}
    g = Grouping(range_words=range_words, ranges=ranges, bound_chars=4)
    assert grouped(spark, counts, g) == brute(counts)


def test_chains_of_forms_end_at_their_root(spark):
    counts = {"aaaaaa" + "b" * i: 6 ** (i + 1) for i in range(9)}
    rows = grouped(spark, counts)
    assert rows == brute(counts)
    assert {r[2] for r in rows} == {"aaaaaa" + "b" * 8}


def test_a_hub_of_variants(spark):
    letters = "abcdefghijklmnopqrstuvwxyz"
    counts = {"letter" + c + "head": 5 for c in letters} | {"letterhead": 1000, "lettermhead": 24}
    rows = grouped(spark, counts)
    assert rows == brute(counts)
    assert sum(r[1] == "letterhead" for r in rows) == 26


def test_very_long_words(spark):
    long = "ab" * 30_000
    counts = {long: 500, long[:-1]: 7, long[:25_000] + "c" + long[25_001:]: 9, "b" + long: 10,
              long[:100]: 50}
    got = {r[0]: r[1:] for r in grouped(spark, counts)}
    assert [got[w][0] for w in list(counts)[1:4]] == [long] * 3
    assert got[long][3] == 3 and got[long[:100]] == (None, long[:100], 50, 0, None)


def test_words_of_odd_texts(spark, odd_docs, no_docs):
    g = Grouping(min_chars=3, min_count=1)
    texts = [(1, "The THE the ÀÉÎ àéî x1abc2def Œuvre"), (None, "the"), (2, None), (3, ""),
             (4, "don't naïveté " + "z" * 100_000)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    found = {(r.doc_id, r.run) for r in spelling.runs(docs, g).collect()}
    want = {("" if i is None else str(i), run.translate(LOWER)) for i, t in texts
            for run in re.findall("[A-Za-zÀ-ÿ]+", t or "") if len(run) >= 3}
    assert found == want
    for df in (odd_docs, no_docs):
        counts = spelling.counted(spelling.misspelled(spelling.runs(df, g)), g)
        want_ = Counter()
        for r in df.collect():
            for run in re.findall("[A-Za-zÀ-ÿ]+", r.text or ""):
                run = run.translate(LOWER)
                h = zlib.crc32(f"{'' if r.doc_id is None else r.doc_id}:{run}".encode())
                if h % 199 == 0:
                    run = run[:h % len(run)] + run[h % len(run) + 1:]
                want_[run] += 1
        want_ = {w: n for w, n in want_.items() if len(w) >= 3}
        # runs shorter than the least length can't be long enough after a deletion
        assert {r.word: r.n for r in counts.collect()} == want_
        assert sorted(map(tuple, spelling.variants(counts, g).collect())) == brute(want_)


def test_nodes_are_those_of_a_trie():
    rnd = random.Random(3)
    words = sorted({"".join(rnd.choice("abc") for _ in range(rnd.randint(1, 6)))
                    for _ in range(300)})
    for n_bounds in (0, 1, 9, 40):
        bounds = sorted({w[:3] for w in rnd.sample(words, n_bounds)})
        rows = sorted((sum(b <= w for b in bounds), w) for w in words)
        numbers, ids = defaultdict(set), []
        cut = [r for part in range(len(bounds) + 1) for r in rows if r[0] == part]
        for part in range(len(bounds) + 1):  # every range on its own, as in tasks
            own = [r for r in cut if r[0] == part]
            for (_, w), (id_, path) in zip(own, scan(Bounds(bounds), iter(own))):
                ids.append((id_, w))
                for i in range(len(w) + 1):
                    numbers[w[:i]].add(path[i])
        assert all(len(s) == 1 for s in numbers.values())
        assert len({next(iter(s)) for s in numbers.values()}) == len(numbers)
        assert [w for _, w in sorted(ids)] == words


def test_another_parameter_set(spark):
    counts = {"abc": 1, "abd": 2, "abcd": 9}
    assert grouped(spark, counts, replace(Grouping(), ratio=2)) == brute(counts, 2)
