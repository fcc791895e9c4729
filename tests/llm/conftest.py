from __future__ import annotations

import pytest

#: Texts that each operator must stand: null, empty, blank, controls, long, ties, repeats.
ODD_TEXTS = [None, "", " ", "\n", "\t\n \r", "a", "a b", "One two three", "one TWO three",
             "x\x00y \x01", "naïve café Straße ŒUVRE ÑANDÚ", "漢字 かな 😀 👍🏽", "a  b   c ",
             "<s>[INST] \\ </s>", "it's we'll 123 45,6", "word " * 3000, "z" * 3000,
             "line one is long enough here\n" * 4, "<|endoftext|> x <|endoftext|>"]


@pytest.fixture
def odd_docs(spark):
    """Odd texts under ids, two repeated rows, a row without id, and a clashing column."""
    rows = [(i, t, "en", "s", 7) for i, t in enumerate(ODD_TEXTS)]
    rows += [rows[9], rows[9], (None, "a text without an id here", None, None, None),
             (None, None, None, None, None)]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, kept long")


@pytest.fixture
def no_docs(spark):
    return spark.createDataFrame(
        [], "doc_id long, text string, lang string, source string, n_chars long")
