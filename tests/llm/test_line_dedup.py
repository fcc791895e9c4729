from __future__ import annotations

from collections import defaultdict

from vitrail.llm import line_dedup
from vitrail.llm.common import table
from vitrail.plans.compare import compare, duck_connection

from ..conftest import SF01

BLANK = " \t\n\x0b\f\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, min_chars=20, min_docs=3):
    holders = defaultdict(set)
    for doc_id, text in rows:
        for line in (text or "").split("\n"):
            key = line.strip(BLANK).translate(LOWER)
            if len(key) >= min_chars:
                holders[key].add(float("-inf") if doc_id is None else doc_id)
    out = []
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        mine = float("-inf") if doc_id is None else doc_id
        left = []
        for line in lines:
            docs = holders.get(line.strip(BLANK).translate(LOWER), ())
            if len(docs) < min_docs or mine == max(docs):
                left.append(line)
        out.append((doc_id, len(lines), len(lines) - len(left), "\n".join(left)))
    return out


def key(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[3]))


def check(docs):
    got = line_dedup.dedup_lines(docs).select("doc_id", "n_lines", "n_dropped", "kept_text")
    want = brute([(r.doc_id, r.text) for r in docs.collect()])
    assert key([tuple(r) for r in got.collect()]) == key(want)


def test_oracle(spark):
    df = line_dedup.op2_line_dedup(spark, SF01)
    rel = duck_connection(SF01).sql(line_dedup.OP2_SQL)
    assert compare(df.columns, [tuple(r) for r in df.collect()], rel.columns,
                   rel.fetchall()) is None


def test_documents(spark):
    check(table(spark, SF01, "documents").select("doc_id", "text"))


def test_ties_case_and_ends(spark):
    a = "This line is shared by many"
    check(spark.createDataFrame(
        [(1, a), (2, f"  {a.upper()}\t\nown"), (3, f"{a}\n{a}\nx"), (3, a), (4, "É" * 20),
         (5, "é" * 20), (6, "É" * 20), (7, None), (None, a), (None, f"{a}\ny"),
         (8, "short line\nshort line"), (9, a[:19]), (10, a[:20]), (11, a[:20]), (12, a[:20])],
        "doc_id long, text string"))


def test_odd_rows(odd_docs, no_docs):
    check(odd_docs)
    assert line_dedup.dedup_lines(odd_docs).columns == [
        *odd_docs.columns, "n_lines", "n_dropped", "kept_text"]
    assert line_dedup.dedup_lines(no_docs).count() == 0


def test_clashing_columns(spark):
    docs = spark.createDataFrame([(1, "t", "a", 5)],
                                 "doc_id long, text string, _lines string, N_LINES long")
    row = line_dedup.dedup_lines(docs).first()
    assert row["_lines"] == "a" and row["n_lines"] == 1
