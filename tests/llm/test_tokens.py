from __future__ import annotations

import hashlib
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from vitrail.llm import byte_bpe, packing, token_counts
from vitrail.llm.common import table

from ..conftest import SF001

MODEL = public_tokenizers.path("piece_bpe_32k.model")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def pieces():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def ranked():
    return byte_bpe.rank_encoder(RANKS, PATTERN)


@pytest.fixture(scope="module")
def file_tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


TEXT = st.text(alphabet=st.sampled_from("ab é▁ \n\t.,'s1<|endoftext|>漢😀"), max_size=60)


@settings(max_examples=200, deadline=None)
@given(text=TEXT)
def test_parts_count_like_the_whole_text(pieces, text):
    assert sum(len(pieces.encode(p)) for p in token_counts.parts_of(text)) == len(
        pieces.encode(text))


@settings(max_examples=200, deadline=None)
@given(text=TEXT, most=st.integers(1, 10))
def test_bpe_parts_encode_like_the_whole_text(ranked, text, most):
    parts = list(byte_bpe.parts_of(text, most))
    assert "".join(parts) == text
    assert [i for p in parts for i in ranked.encode_ordinary(p)] == ranked.encode_ordinary(text)


@settings(max_examples=200, deadline=None)
@given(text=TEXT)
def test_rank_file_gives_the_ids_of_the_tokenizer_file(file_tokenizer, text):
    own = byte_bpe.rank_encoder(RANKS, PATTERN, packing.SPECIAL)
    assert own.encode(text, allowed_special="all") == file_tokenizer.encode(
        text, add_special_tokens=False).ids


def test_boundaries_are_checked():
    with pytest.raises(ValueError, match="across spaces"):
        token_counts.check_boundaries(["a", "a▁b"])


def test_token_counts(spark, odd_docs, no_docs, pieces):
    docs = odd_docs.select("doc_id", "text").union(
        table(spark, SF001, "documents").select("doc_id", "text"))
    for r in token_counts.count_tokens(docs, MODEL, limit=50).collect():
        n = len(pieces.encode(r.text or ""))
        assert (r.n_tokens, r.n_bytes, r.over_limit) == (n, len((r.text or "").encode()), n > 50)
    assert token_counts.count_tokens(no_docs, MODEL).count() == 0


def test_encode_and_decode(spark, odd_docs, no_docs, ranked):
    docs = odd_docs.withColumn("ids", F.lit("clash"))
    out = byte_bpe.encode_texts(docs, RANKS, PATTERN)
    rows = out.withColumn("raw", byte_bpe.decode_ids(F.col("ids"), RANKS, PATTERN)).collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert r.ids == ranked.encode_ordinary(r.text or "")
        assert bytes(r.raw) == (r.text or "").encode()
    assert byte_bpe.encode_texts(no_docs, RANKS, PATTERN).count() == 0


def test_half_a_character_decodes_to_raw_bytes(spark, ranked):
    ids = ranked.encode_ordinary("漢")
    row = spark.createDataFrame([(ids[:1],), (None,)], "ids array<int>").select(
        byte_bpe.decode_ids(F.col("ids"), RANKS, PATTERN).alias("raw")).collect()
    assert bytes(row[0].raw) == ranked.decode_bytes(ids[:1]) and bytes(row[1].raw) == b""


def test_op8_digests(spark, ranked):
    texts = {r.doc_id: r.text for r in table(spark, SF001, "documents").collect()}
    for r in byte_bpe.op8_byte_bpe(spark, SF001).collect():
        ids = ranked.encode_ordinary(texts[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def check_packing(rows, texts, file_tokenizer, capacity=2048):
    """``texts``: list of (doc_id, text), ids distinct."""
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for doc_id, text in texts:
        ids = np.array(file_tokenizer.encode(text or "", add_special_tokens=False).ids + [0], "<u4")
        own = sorted(by_doc[doc_id], key=lambda r: r.piece)
        assert [r.piece for r in own] == list(range(-(-len(ids) // capacity)))
        at = 0
        for r in own:
            assert r.start == at and zlib.crc32(ids[at:at + r.length].tobytes()) == r.ids_crc32
            at += r.length
        assert at == len(ids) and all(r.length == capacity for r in own[1:])
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by_sequence)


def test_packing_documents(spark, file_tokenizer):
    texts = [(r.doc_id, r.text) for r in table(spark, SF001, "documents").collect()]
    rows = packing.op7_best_fit_packing(spark, SF001).collect()
    n = check_packing(rows, texts, file_tokenizer)
    assert n <= -(-sum(r.length for r in rows) // 2048) + 2


def test_packing_odd_rows(spark, odd_docs, no_docs, file_tokenizer):
    docs = odd_docs.where("doc_id is not null").dropDuplicates(["doc_id"])
    out = packing.pack_documents(docs, RANKS, PATTERN, packing.SPECIAL, capacity=64,
                                 keep_ids=True)
    rows = out.collect()
    check_packing(rows, [(r.doc_id, r.text) for r in docs.collect()], file_tokenizer, 64)
    whole = {r.sequence_id: r.ids for r in packing.sequences(out).collect()}
    for r in rows:
        assert whole[r.sequence_id][r.offset:r.offset + r.length] == r.ids
    every = packing.pack_documents(odd_docs, RANKS, PATTERN, packing.SPECIAL).collect()
    assert len({(r.sequence_id, r.offset) for r in every}) == len(every)
    assert packing.pack_documents(no_docs, RANKS, PATTERN, packing.SPECIAL).count() == 0


@settings(max_examples=40, deadline=None)
@given(lengths=st.lists(st.integers(1, 50), max_size=300))
def test_plan_holds_every_length(lengths):
    counts = np.bincount(lengths, minlength=51) if lengths else np.zeros(51, int)
    classes = packing.plan(counts, 50, groups=5)
    held = np.zeros(51, int)
    for parts, n in classes:
        assert sum(parts) <= 50 and n > 0
        for x in parts:
            held[x] += n
    assert (held == counts).all()
    # first fit never needs more than twice the volume, and neither does the plan
    assert sum(n for _, n in classes) <= 2 * sum(lengths) / 50 + 1


def test_configurations_reach_the_bound_of_halves_and_thirds():
    ways, used = packing.configurations(np.array([20, 30]), np.array([10.0, 10.0]), 50)
    assert sum(used) == pytest.approx(10) and (ways @ [20, 30] <= 50).all()
