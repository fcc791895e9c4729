"""Texts of several MB, with and without places to cut them, through Spark."""

from __future__ import annotations

import hashlib
import math
import zlib

import numpy as np
import public_tokenizers
import pytest

from vitrail.llm import byte_bpe, line_dedup, packing, quality, token_counts, toxicity

MODEL = public_tokenizers.path("piece_bpe_32k.model")
RANKS, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN

WORDS = " ".join(f"word{i % 977}" for i in range(250_000))           # 1.9 MB, spaces
LINES = "\n".join(f"line {i % 40_000} of a long text" for i in range(60_000))
BLOCK = "é漢x" * 300_000                                             # 1.8 MB, no place to cut
TEXTS = {1: WORDS, 2: LINES, 3: BLOCK}


@pytest.fixture
def docs(spark):
    return spark.createDataFrame([(i, t, "en", "kept") for i, t in TEXTS.items()],
                                 "doc_id long, text string, lang string, extra string")


def test_token_counts(docs):
    import sentencepiece

    pieces = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    clash = docs.selectExpr("*", "'old' as n_tokens", "1 as N_BYTES", "2 as _text", "3 as _n")
    got = {r.doc_id: r for r in token_counts.count_tokens(clash, MODEL).collect()}
    for i, text in TEXTS.items():
        assert got[i].n_tokens == len(pieces.encode(text))
        assert got[i].n_bytes == len(text.encode()) and got[i].over_limit
        assert (got[i].extra, got[i]._text, got[i]._n) == ("kept", 2, 3)


def test_byte_bpe(docs):
    own = byte_bpe.rank_encoder(RANKS, PATTERN)
    out = byte_bpe.encode_texts(docs, RANKS, PATTERN)
    out = out.select("doc_id", "ids", byte_bpe.decode_ids(out["ids"], RANKS, PATTERN).alias("raw"))
    for r in out.collect():
        assert r.ids == own.encode_ordinary(TEXTS[r.doc_id])
        assert bytes(r.raw).decode() == TEXTS[r.doc_id]


def test_packing(docs):
    own = byte_bpe.rank_encoder(RANKS, PATTERN)
    got = {}
    for r in packing.pack_production(docs).collect():
        got.setdefault(r.doc_id, []).append(r)
    for i, text in TEXTS.items():
        ids = np.array([*own.encode_ordinary(text), 0], dtype="<u4")
        parts = sorted(got[i], key=lambda r: r.piece)
        assert sum(r.length for r in parts) == len(ids)
        for r in parts:
            piece = ids[r.start:r.start + r.length]
            assert r.ids_crc32 == zlib.crc32(piece.tobytes()) and r.length <= 2048


def test_line_dedup(docs):
    got = {r.doc_id: r for r in line_dedup.dedup_lines(docs).collect()}
    for i, text in TEXTS.items():
        assert got[i].n_lines == text.count("\n") + 1 and got[i].n_dropped == 0
        assert hashlib.sha256(got[i].kept_text.encode()).digest() == hashlib.sha256(
            text.encode()).digest()


def test_quality_measures(docs):
    got = {r.doc_id: r for r in quality.judge(docs).collect()}
    assert (got[1].n_words, got[1].n_repeat_words) == (250_000, 250_000)
    # lines come back after 40,000: the first 20,000 twice, with the words around them
    words = LINES.split()
    seen: dict = {}
    for i in range(len(words) - 2):
        seen.setdefault(tuple(words[i:i + 3]), []).append(i)
    covered = {k for at in seen.values() if len(at) > 1 for i in at for k in (i, i + 1, i + 2)}
    assert got[2].n_repeat_words == len(covered)
    assert got[3].n_words == 1 and got[3].base_failed


def test_both_ways_of_meeting_agree(spark, monkeypatch):
    texts = ["a b c a b c d", "x y z " * 40, "one two", "", " ".join("abcab"), "q " * 7]
    df = spark.createDataFrame([(t,) for t in texts], "text string").selectExpr(
        "text", "array_remove(split(text, ' '), '') as w")
    found = []
    for bits in (14, 0):
        monkeypatch.setattr(quality, "PACKED_BITS", bits)
        found.append([r.n for r in df.select("text", quality.repeated_words("w").alias(
            "n")).collect()])
    assert found[0] == found[1] == [6, 120, 0, 0, 0, 7]


def test_toxicity_features_of_long_texts(docs):
    out = docs.select("doc_id", toxicity.feature_function({"word7": 1.0}, 3)("text").alias("f"))
    got = {r.doc_id: r.f for r in out.collect()}
    n = sum(w.startswith("word7") for w in WORDS.split())  # digits are no part of a word
    assert got[1][0] == pytest.approx(n / 250_000)
    assert got[1][-1] == pytest.approx(math.log(250_000))
    assert got[3][:3] == [0.0, 0.0, 0.0]


def test_toxicity_features_by_hand(spark):
    text = "You are BAD, stupid!! b@d"  # 5 words, 25 characters
    df = spark.createDataFrame([(text,)], "text string")
    got = dict(zip(toxicity.FEATURES, df.select(toxicity.feature_function(
        {"bad": 2.0, "stup*": 1.5}, 3)("text").alias("f")).first().f))
    assert got == pytest.approx({
        "hit_density": 2 / 5, "hit_weight": 3.5 / 5, "distinct_hits": 2.0, "near_you": 2 / 5,
        "you_density": 1 / 5, "capitals": 4 / 25, "shouted_words": 1 / 5, "loud_marks": 2 / 5,
        "marks": 4 / 25, "disguised": 1 / 5, "disguised_hits": 1.0, "log_words": math.log(5)})


def test_scores_replace_columns_of_their_name(spark, docs):
    from vitrail.llm.common import table

    path = "/root/testdata/sf0.01"
    model = toxicity.fit(table(spark, path, "documents"), table(spark, path, "labels"))
    clash = docs.selectExpr("*", "'old' as score", "'old' as PREDICTED", "1 as features",
                            "2 as margin", "3 as rawPrediction")
    rows = model.score(clash).collect()
    assert all(0 <= r.score <= 1 and r.predicted in (0, 1) for r in rows)
    assert {(r.features, r.margin, r.rawPrediction) for r in rows} == {(1, 2, 3)}
