from __future__ import annotations

from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from vitrail.llm import components, jaccard_join
from vitrail.llm.common import table
from vitrail.llm.jaccard_join import Similarity, gram_set

from ..conftest import SF001, SF01


def brute(rows, s):
    """doc_id -> (sizes, component) by comparing all pairs that share an n-gram."""
    sets = [(i, gram_set(t or "", s.words)) for i, t in rows]
    holders = defaultdict(list)
    for k, (_, grams) in enumerate(sets):
        for g in grams:
            holders[g].append(k)
    parent = {i: i for i, _ in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, (i, grams) in enumerate(sets):
        for j, both in Counter(o for g in grams for o in holders[g] if o < k).items():
            union = len(grams) + len(sets[j][1]) - both
            if 100 * both >= s.percent * union:
                a, b = root(i), root(sets[j][0])
                parent[max(a, b)] = min(a, b)
    return sorted((i, len(grams), root(i)) for i, grams in sets)


def check(docs, s):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = jaccard_join.similar_groups(docs, s)
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got.collect()) == brute(rows, s)


@pytest.mark.parametrize("s", [Similarity(), Similarity(5, 80)])
def test_documents(spark, s):
    check(table(spark, SF01, "documents").select("doc_id", "text"), s)


def edited(seed, n_docs, n_words, most):
    rng = np.random.default_rng(seed)
    words = [f"w{i}" for i in range(n_words)]
    out = []
    for i in range(n_docs):
        own = list(words)
        for at in rng.choice(n_words, rng.integers(0, most + 1), replace=False):
            own[at] = f"d{i}x{at}"
        out.append((i, " ".join(own)))
    return out


def test_edited_copies_are_linked_by_exact_similarity(spark):
    # copies around the threshold: some link to the original only, some to others only
    rows = edited(3, 120, 120, 8) + [(1000 + i, t) for i, t in edited(4, 60, 40, 3)]
    check(spark.createDataFrame(rows, "doc_id long, text string"), Similarity(3, 90))


def test_a_chain_of_links_is_one_component(spark):
    words = [f"w{i}" for i in range(100)]
    rows = []
    for i in range(12):  # each differs from the next in two words, the ends in all of them
        rows.append((20 - i, " ".join([f"n{k}" for k in range(2 * i)] + words[2 * i:])))
    got = jaccard_join.similar_groups(
        spark.createDataFrame(rows, "doc_id long, text string"), Similarity(1, 90)).collect()
    assert {r.component_id for r in got} == {9}


def test_salted_groups_lose_nothing(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "SALT_ROWS", 5)
    rows = edited(5, 150, 60, 2)
    check(spark.createDataFrame(rows, "doc_id long, text string"), Similarity(3, 90))


def test_exact_threshold(spark):
    rows = [(1, " ".join(f"a{i}" for i in range(19))),
            (2, " ".join([f"a{i}" for i in range(18)] + ["b"])),
            (3, " ".join(f"A{i}" for i in range(19))), (4, "a b"), (5, "A  B"), (6, "a b c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for s in (Similarity(1, 90), Similarity(3, 90), Similarity(3, 100)):
        check(docs, s)


def test_odd_rows(odd_docs, no_docs):
    out = jaccard_join.similar_groups(odd_docs).collect()
    assert len(out) == odd_docs.count()
    for r in out:
        assert r.n_shingles == len(gram_set(r.text or "", 3))
        if r.doc_id is None:
            assert r.component_id is None
        elif not r.n_shingles:
            assert r.component_id == r.doc_id
    by_id = {r.doc_id: r.component_id for r in out}
    assert by_id[8] == by_id[7] == 7  # the same words in another case
    kept = jaccard_join.one_of_each(odd_docs).collect()
    assert len(kept) == len({r.doc_id for r in kept if r.doc_id is not None}) + 2
    assert 7 in {r.doc_id for r in kept} and 8 not in {r.doc_id for r in kept}
    assert jaccard_join.similar_groups(no_docs).count() == 0


def test_components_of_a_long_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + i) for i in range(1, 50)] + [(7, 7)]
    rows = components.components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.node: r.component for r in rows} == {
        **{i: 0 for i in range(61)}, **{100 + i: 100 for i in range(50)}}
    none = spark.createDataFrame([], "a long, b long")
    assert components.components(none).count() == 0


def test_hashes_follow_the_words(spark):
    hasher = jaccard_join.Hasher(3)
    for r in table(spark, SF001, "documents").collect():
        assert len(hasher.ngrams(r.text)) == len(gram_set(r.text, 3))
    assert (hasher.ngrams("The  CAT\tsat on") == hasher.ngrams("the cat sat on")).all()
    assert len(hasher.ngrams(None)) == 0 and len(hasher.ngrams(" \n")) == 0


def form_letters(n, slots=20, seed=6):
    """Letters of one form: two wordings for each slot, so that most pairs share rare
    n-grams and hardly any is similar enough."""
    rng = np.random.default_rng(seed)
    wordings = [[" ".join(f"s{k}v{v}w{i}" for i in range(8)) for v in (0, 1)] for k in range(slots)]
    return [(i, " ".join(wordings[k][v] for k, v in enumerate(rng.integers(0, 2, slots))))
            for i in range(n)]


def test_form_letters_leave_their_groups_only_where_they_may_link(spark, monkeypatch):
    counts = []
    links = jaccard_join.Verifier.links

    def counted(self, pairs):
        counts.append(pairs.count())
        return links(self, pairs)

    monkeypatch.setattr(jaccard_join.Verifier, "links", counted)
    check(spark.createDataFrame(form_letters(600), "doc_id long, text string"), Similarity(3, 90))
    assert max(counts) <= 600  # of 180,000 pairs


def test_tiles_of_a_group_lose_nothing(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "TILE_ROWS", 7)
    check(spark.createDataFrame(form_letters(80, 6) + [(1000 + i, t) for i, t in edited(
        7, 60, 50, 3)], "doc_id long, text string"), Similarity(3, 80))


def test_tiles_over_batches(spark):
    rows = [(h, i, j, b, 10 * h + k, 20, 0, k, bytes([1, 0] * 64))
            for h, i, j in ((0, 0, 0), (1, 0, 1), (2, 0, 0)) for k, b in enumerate((0, 1, 0, 1))]
    names = ["h", "i", "j", "block", "id", "n", "at", "c", "bins"]

    def batches(size):
        for start in range(0, len(rows), size):
            yield pa.RecordBatch.from_arrays(
                [pa.array(c) for c in zip(*rows[start:start + size])], names)

    found = {size: sorted((a, b) for out in jaccard_join.pairs_in_place(batches(size), 80)
                          for a, b in zip(*(c.to_pylist() for c in out.columns)))
             for size in (1, 3, 100)}
    inside = [(0, 1), (0, 2), (0, 3), (1, 2), (1, 3), (2, 3)]
    want = inside + [(10, 11), (10, 13), (11, 12), (12, 13)] + [(20 + a, 20 + b) for a, b in inside]
    assert found[1] == found[3] == found[100] == want


def test_one_of_each_loses_no_text(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(30)) for x in "abc")
    rows = [(1, a, "x"), (1, b, "x"), (1, b, "y"), (2, b + " more", "x"), (3, c, "x"), (4, c, "z"),
            (None, a, "n"), (None, c + " end", "n"), (5, "", "e"), (6, None, "e"), (1, None, "e")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, set_id string")
    kept = jaccard_join.one_of_each(docs, Similarity(3, 80))
    assert kept.columns == docs.columns
    rows = kept.collect()
    texts = sorted((r.text or "").split(" ")[0] for r in rows)
    # a, b and c once each, and three different documents without words
    assert texts == ["", "", "", "a0", "b0", "c0"]
    assert {r.doc_id for r in rows if (r.text or "").startswith("c0")} == {3}
    assert {r.doc_id for r in rows if (r.text or "").startswith("b0")} == {2}


def test_rows_of_one_id_keep_their_own_size(spark):
    docs = spark.createDataFrame([(1, "a b c d"), (1, "x y z"), (1, "x y z"), (2, "a b c d")],
                                 "doc_id long, text string, n_shingles string".rsplit(",", 1)[0])
    got = sorted(map(tuple, jaccard_join.similar_groups(docs).select(
        "doc_id", "text", "n_shingles", "component_id").collect()))
    assert got == [(1, "a b c d", 2, 1), (1, "x y z", 1, 1), (1, "x y z", 1, 1),
                   (2, "a b c d", 2, 1)]


def test_clashing_names_and_long_texts(spark):
    long = " ".join(f"w{i}" for i in range(300_000))  # some 2 MB
    docs = spark.createDataFrame(
        [(1, long, 7, "q"), (2, long + " end", 8, "r"), (3, "x" * 2_000_000, 9, "s")],
        "doc_id long, text string, n_shingles int, set_size string")
    got = {r.doc_id: r for r in jaccard_join.similar_groups(docs).collect()}
    assert [got[i].n_shingles for i in (1, 2, 3)] == [299_998, 299_999, 1]
    assert [got[i].component_id for i in (1, 2, 3)] == [1, 1, 3]
    assert [got[i].set_size for i in (1, 2, 3)] == ["q", "r", "s"]
