from __future__ import annotations

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from vitrail.llm import chat
from vitrail.plans.compare import compare, duck_connection

from ..conftest import SF001

MESSAGE = "tree long, node long, parent long, role string, text string, score double"


def test_oracle(spark):
    df = chat.op3_chat_format(spark, SF001)
    rel = duck_connection(SF001).sql(chat.OP3_SQL)
    assert compare(df.columns, [tuple(r) for r in df.collect()], rel.columns,
                   rel.fetchall()) is None


def told(spark, rows, branches=1):
    messages = spark.createDataFrame(rows, MESSAGE)
    out = chat.format_paths(messages, chat.chosen_paths(messages, branches))
    return out.withColumn("turns", chat.turns_of("formatted")).withColumn(
        "learned", chat.loss_text("segments")).orderBy("tree", "branch").collect()


TREE = [(1, 1, None, "user", "q", 0.0), (1, 2, 1, "assistant", "good", 2.0),
        (1, 3, 1, "assistant", "bad", 1.0), (1, 4, 2, "user", "more", 0.0),
        (1, 5, 4, "assistant", "end", 0.5), (1, 6, 3, "user", "why", 5.0),
        (2, 1, None, "user", "alone", 0.0),
        (3, 1, 2, "user", "cycle", 9.0), (3, 2, 1, "user", "cycle", 9.0),
        (4, 5, 99, "user", "orphan", 1.0), (4, 6, 5, None, None, 1.0)]


def test_best_branch(spark):
    got = {r.tree: [(t.role, t.text) for t in r.turns] for r in told(spark, TREE)}
    assert got == {1: [("user", "q"), ("assistant", "bad"), ("user", "why")],
                   2: [("user", "alone")], 4: [("user", "orphan"), ("", "")]} or got == {
        1: [("user", "q"), ("assistant", "bad"), ("user", "why")],
        2: [("user", "alone")], 4: [("user", "orphan"), (None, None)]}


def test_two_branches_learn_a_shared_text_once(spark):
    rows = [(1, 1, None, "user", "q", 0.0), (1, 2, 1, "assistant", "shared", 0.0),
            (1, 3, 2, "assistant", "a", 2.0), (1, 4, 2, "assistant", "b", 1.0)]
    assert [r.learned for r in told(spark, rows, 2)] == ["shareda", "b"]


def test_long_chain_and_ties(spark):
    rows = [(1, i, i - 1 if i else None, "assistant", f"{i};", 1.0) for i in range(70)]
    rows += [(2, 1, None, "user", "r", 0.0), (2, 2, 1, "user", "x", 1.0),
             (2, 3, 1, "user", "y", 1.0)]
    one, two = told(spark, rows)
    assert one.learned == "".join(f"{i};" for i in range(70))
    assert [t.text for t in two.turns] == ["r", "x"]


PART = st.lists(st.sampled_from(["<s>", "</s>", "[INST]", "[/INST]", "\\", "<", "s>", "/s>", "[",
                                 "INST]", "\n", "é😀", "ok"]), max_size=8).map("".join)


@settings(max_examples=3, deadline=None)
@given(texts=st.lists(st.tuples(PART, PART), min_size=40, max_size=40))
def test_template_is_reversible(spark, texts):
    rows = [(i, 1, None, a, b, 0.0) for i, (a, b) in enumerate(texts)]
    for r in told(spark, rows):
        assert [(t.role, t.text) for t in r.turns] == [texts[r.tree]]
        for mark in ("<s>", "</s>", "[INST]", "[/INST]"):
            assert r.formatted.count(mark) == 1


def test_turns_with_gaps_nulls_and_repeats(spark):
    rows = [(1, 5, "user", "b"), (1, 2, "user", None), (1, 9, None, "c"), (1, 5, "assistant", "a"),
            (1, 5, "user", "b"), (None, 1, "user", "lost"), (2, None, "user", "first"),
            (2, 0, "user", "second")]
    table_ = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    messages = chat.by_turn(table_.withColumn("node", F.lit("clash")))
    out = chat.format_paths(messages, chat.chosen_paths(messages)).withColumn(
        "turns", chat.turns_of("formatted"))
    got = {r.tree: [(t.role, t.text) for t in r.turns] for r in out.collect()}
    assert got[1] == [("user", ""), ("assistant", "a"), ("user", "b"), ("user", "b"), ("", "c")]
    assert got[2] == [("user", "first"), ("user", "second")] and len(got) == 3
    empty = chat.by_turn(table_.limit(0))
    assert chat.format_paths(empty, chat.chosen_paths(empty)).count() == 0
