"""Ingest: header handling, width accounting, quoting, NULLs, types, text sources."""

from __future__ import annotations

import csv
import hashlib
import io
import sys
import unicodedata

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.ml.functions import vector_to_array

from vitrail.functions.text import strip_accents
from vitrail.sources import delimited, points

DIRTY = "\n".join([
    "a;b;c",
    "1;2;3",          # good
    "4;5",            # short
    "6;7;8;9",        # long
    "a;b;c",          # repeated header (concatenated files)
    '"x;y";10;11',    # quoted field holding the separator
    '12;"";13',       # empty quoted field -> NULL
    "",               # blank line: zero fields, malformed
    '14;"q""r";15',   # escaped quote inside a quoted field
]) + "\n"


def write(workdir, name, text):
    path = workdir / name
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_profile_counts_malformed_before_filtering(spark, workdir):
    path = write(workdir, "dirty.csv", DIRTY)
    prof = delimited.load_profile(spark, path, ";", name="dirty").collect()[0]
    assert (prof.file, prof.n_cols, prof.n_rows, prof.n_malformed) == ("dirty", 3, 4, 3)


def test_good_rows_quotes_and_nulls(spark, workdir):
    path = write(workdir, "dirty.csv", DIRTY)
    df = delimited.load_table(spark, path, ";")
    assert df.columns == ["a", "b", "c"]
    rows = sorted(tuple(r) for r in df.collect())
    assert ("1", "2", "3") in rows
    assert ("x;y", "10", "11") in rows
    assert ("12", None, "13") in rows
    # quotes are stripped from values (the original loader's coercion)
    assert any(r[0] == "14" and r[1] in ("qr", 'q"r') and '"' not in (r[1] or "") for r in rows)
    assert len(rows) == 4


def test_malformed_rows_are_kept_for_inspection(spark, workdir):
    path = write(workdir, "dirty.csv", DIRTY)
    parsed = delimited.parse_lines(delimited.read_lines(spark, path), ";")
    bad = sorted(r.value for r in delimited.malformed_rows(parsed).collect())
    assert bad == ["", "4;5", "6;7;8;9"]


def test_header_tokens_and_names(spark, workdir):
    path = write(workdir, "q.csv", '"Sodium";"Type"\n1.5;1\n')
    tokens = delimited.header_of(delimited.read_lines(spark, path), ";")
    assert delimited.column_names(tokens) == ["Sodium", "Type"]


def test_typed_load_and_try_cast(spark, workdir):
    text = "n;x;k;d\nfoo;1.5;3;2020-01-02\nbar;oops;x;not-a-date\n"
    path = write(workdir, "typed.csv", text)
    df = delimited.load_table(spark, path, ";", types=["str", "number", "bin", "date"])
    assert [f.dataType.typeName() for f in df.schema.fields] == ["string", "float", "integer", "date"]
    rows = {r.n: r for r in df.collect()}
    assert rows["foo"].x == pytest.approx(1.5) and rows["foo"].k == 3
    assert str(rows["foo"].d) == "2020-01-02"
    assert rows["bar"].x is None and rows["bar"].k is None and rows["bar"].d is None


def test_type_words_are_checked():
    with pytest.raises(ValueError):
        delimited.build_schema(["str"], ["a", "b"])
    with pytest.raises(ValueError):
        delimited.build_schema(["str", "blob"], ["a", "b"])
    schema = delimited.build_schema(["str", "number"], ['"a"', "b"])
    assert schema.names == ["a", "b"]


def test_sampling_needs_a_seed(spark, workdir):
    path = write(workdir, "s.csv", "a\n" + "\n".join(str(i) for i in range(200)) + "\n")
    with pytest.raises(ValueError):
        delimited.load_table(spark, path, ";", sample=0.5)
    n = delimited.load_table(spark, path, ";", sample=0.5, seed=3).count()
    assert 50 < n < 150


def test_concatenated_files_drop_every_header(spark, workdir):
    p1 = write(workdir, "p1.csv", "a;b\n1;2\n")
    p2 = write(workdir, "p2.csv", "a;b\n3;4\n")
    df = delimited.load_table(spark, [p1, p2], ";")
    assert sorted(tuple(r) for r in df.collect()) == [("1", "2"), ("3", "4")]


def test_accents_are_folded_in_the_loader(spark, workdir):
    path = write(workdir, "acc.csv", "nom;ville\nÉlodie;Besançon\n")
    row = delimited.load_table(spark, path, ";").collect()[0]
    assert (row.nom, row.ville) == ("Elodie", "Besancon")


def nfkd(s):
    """The definition: decompose, then leave out what has a combining class."""
    return "".join(c for c in unicodedata.normalize("NFKD", s) if not unicodedata.combining(c))


def test_accents_of_every_code_point(spark):
    known = [chr(c) for c in range(sys.maxunicode + 1) if not 0xD800 <= c <= 0xDFFF
             and unicodedata.category(chr(c)) != "Cn"]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(known)], "i int, t string")
    got = {r.i: r.f for r in df.select("i", strip_accents("t").alias("f")).collect()}
    assert [hex(ord(c)) for i, c in enumerate(known) if got[i] != nfkd(c)] == []


def test_accents_in_texts_and_nulls(spark):
    texts = ["ﬁne Œuvre ½ café", "plain", "", None, "한글", "e\u0301\u0323x", "😀 é"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r.i: r.f for r in df.select("i", strip_accents("t").alias("f")).collect()}
    assert got == {i: None if t is None else nfkd(t) for i, t in enumerate(texts)}


def test_header_splits_like_the_rows(spark, workdir):
    path = write(workdir, "h.csv", '\ufeff"a;1";"b""c";d;\n1;2;3;4\n')
    lines = delimited.read_lines(spark, path)
    assert delimited.header_of(lines, ";") == ["a;1", 'b"c', "d", ""]


def test_blank_lines_count_in_other_charsets(spark, workdir):
    path = workdir / "cp1252.csv"
    path.write_bytes("a;b\n1;€é\n\n2\n".encode("cp1252"))
    prof = delimited.load_profile(spark, str(path), ";", encoding="cp1252").first()
    assert (prof.n_rows, prof.n_malformed) == (1, 2)
    row = delimited.load_table(spark, str(path), ";", encoding="cp1252", accents=False).first()
    assert row.b == "€é"
    with pytest.raises(ValueError):
        delimited.read_lines(spark, str(path), encoding="iso2022_jp")


def test_values_that_do_not_fit_are_counted_or_raise(spark, workdir):
    path = write(workdir, "bad.csv", "a;b;c\n3000000000;x;2020-01-01\n5;1.5;\n;;nope\n")
    types = ["bin", "number", "date"]
    prof = delimited.load_profile(spark, path, ";", types=types).first()
    assert [(b.column, b.n) for b in prof.n_bad] == [("a", 1), ("b", 1), ("c", 1)]
    wide = delimited.load_table(spark, path, ";", ["long", "str", "str"])
    assert sorted(r.a or 0 for r in wide.collect()) == [0, 5, 3000000000]
    with pytest.raises(Exception, match="not a int"):
        delimited.load_table(spark, path, ";", types, on_bad="raise").collect()


def test_seeded_samples_do_not_depend_on_partitions(spark, workdir):
    path = write(workdir, "s.csv", "a;b\n" + "".join(f"{i};{i % 7}\n" for i in range(3000)))
    one = delimited.load_table(spark, path, ";", sample=0.1, seed=3)
    two = delimited.load_table(spark, path, ";", sample=0.1, seed=3, partitions=9)
    rows = sorted(r.a for r in one.collect())
    assert rows == sorted(r.a for r in two.collect()) and 200 < len(rows) < 400
    other = delimited.load_table(spark, path, ";", sample=0.1, seed=4)
    assert rows != sorted(r.a for r in other.collect())


def test_points_and_edges_account_for_bad_lines(spark):
    lines = spark.createDataFrame([("1 2 3",), ("1 2",), ("x 2 3",), ("",), ("4 5 6 7",)],
                                  "value string")
    tagged = points.tag_labeled_points(lines)
    assert tuple(points.points_profile(tagged).first()) == (1, 3)
    assert [tuple(r.features) for r in points.parse_labeled_points(lines).collect()] == [(2.0, 3.0)]
    chosen = points.parse_labeled_points(lines, feature_indices=[2], width=3)
    assert [tuple(r.features) for r in chosen.collect()] == [(3.0,)]
    edges = spark.createDataFrame([("9007199254740993 1 0.5",), ("1.5 2 1",), ("1 2",)],
                                  "value string")
    assert tuple(points.points_profile(points.tag_edges(edges)).first()) == (1, 2)
    assert points.parse_edges(edges).first().src == 9007199254740993


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.text(alphabet='ab;"x é', min_size=1, max_size=6), min_size=3, max_size=3),
                min_size=1, max_size=8))
def test_roundtrip_of_python_csv_writer(spark, tmp_path_factory, rows):
    buf = io.StringIO()
    w = csv.writer(buf, delimiter=";", quoting=csv.QUOTE_NONNUMERIC, lineterminator="\n")
    w.writerow(["c1", "c2", "c3"])
    w.writerows(rows)
    d = tmp_path_factory.mktemp("rt")
    path = write(d, "rt.csv", buf.getvalue())
    key = lambda t: tuple("\x00" if v is None else v for v in t)
    got = sorted((tuple(r) for r in delimited.load_table(spark, path, ";", accents=False).collect()),
                 key=key)
    # the original coercion: a field reading exactly "" is NULL, other values lose quotes
    expected = sorted((tuple(None if v == '""' else v.replace('"', "") for v in r) for r in rows
                       if r != ["c1", "c2", "c3"]), key=key)
    assert got == expected


def test_labelled_points_label_first_and_label_last(spark):
    lines = spark.createDataFrame([("1 0.5 2.0",), ("0 1.5 -1",), ("",)], "value string")
    rows = points.parse_labeled_points(lines, " ").select("label", vector_to_array("features").alias("f")).collect()
    assert sorted((r.label, tuple(r.f)) for r in rows) == [(0.0, (1.5, -1.0)), (1.0, (0.5, 2.0))]
    label_last = spark.createDataFrame([("1.5;2;3;4;5;6;7;8;3",)], "value string")
    r = points.parse_labeled_points(label_last, ";", label_index=8,
                                    feature_indices=range(8)).first()
    assert r.label == 3.0 and list(r.features) == [1.5, 2, 3, 4, 5, 6, 7, 8]


def test_libsvm_write_read(spark, workdir):
    lines = spark.createDataFrame([("1 0 2.5",), ("0 3 0",)], "value string")
    pts = points.parse_labeled_points(lines, " ")
    path = str(workdir / "svm")
    points.write_libsvm(pts, path)
    back = points.read_libsvm(spark, path, num_features=2)
    got = sorted((r.label, tuple(r.features.toArray())) for r in back.collect())
    assert got == [(0.0, (3.0, 0.0)), (1.0, (0.0, 2.5))]


def test_edge_lines(spark):
    lines = spark.createDataFrame([("0 1 0.9",), ("1 2 0.1",)], "value string")
    rows = sorted(tuple(r) for r in points.parse_edges(lines).collect())
    assert rows == [(0, 1, 0.9), (1, 2, 0.1)]


line_kind = st.sampled_from(["good", "short", "long", "blank", "header"])


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(line_kind, st.lists(st.text(alphabet='ab;"1 ', min_size=1, max_size=5),
                                             min_size=4, max_size=4)),
                min_size=1, max_size=12))
def test_accounting_with_dirty_lines(spark, tmp_path_factory, lines):
    """Every kind of bad line is counted, every good row survives, headers vanish."""
    header = ["h1", "h2", "h3"]
    out = [";".join(header)]
    good = bad = 0
    for kind, vals in lines:
        buf = io.StringIO()
        w = csv.writer(buf, delimiter=";", quoting=csv.QUOTE_ALL, lineterminator="")
        if kind == "good":
            w.writerow(vals[:3])
            good += 1
        elif kind == "short":
            w.writerow(vals[:2])
            bad += 1
        elif kind == "long":
            w.writerow(vals[:4])
            bad += 1
        elif kind == "header":
            buf.write(";".join(header))
        else:
            bad += 1  # blank line
        out.append(buf.getvalue())
    d = tmp_path_factory.mktemp("dirty")
    path = write(d, "d.csv", "\n".join(out) + "\n")
    prof = delimited.load_profile(spark, path, ";", accents=False).first()
    assert (prof.n_rows, prof.n_malformed) == (good, bad)
    assert delimited.load_table(spark, path, ";", accents=False).count() == good


def test_header_from_first_file_when_parts_lack_it(spark, workdir):
    d = workdir / "parts"
    d.mkdir()
    (d / "part-0.csv").write_text("a;b\n1;2\n", encoding="utf-8")
    # a larger part file without a header: Spark would read its split first
    (d / "part-1.csv").write_text("".join(f"{i};{i}\n" for i in range(3, 400)), encoding="utf-8")
    df = delimited.load_table(spark, str(d), ";")
    assert df.columns == ["a", "b"] and df.count() == 398


def test_crlf_and_byte_order_marks(spark, workdir):
    d = workdir / "win"
    d.mkdir()
    (d / "a.csv").write_bytes("﻿a;b\r\n1;é\r\n".encode("utf-8"))
    (d / "b.csv").write_bytes("﻿a;b\r\n2;x\r\n".encode("utf-8"))
    df = delimited.load_table(spark, str(d), ";")
    assert df.columns == ["a", "b"]
    assert sorted(tuple(r) for r in df.collect()) == [("1", "e"), ("2", "x")]
    prof = delimited.load_profile(spark, str(d), ";").first()
    assert (prof.n_rows, prof.n_malformed) == (2, 0)


def test_latin1_files(spark, workdir):
    path = workdir / "latin1.csv"
    path.write_bytes('nom;ville\n"Élodie";Besançon\n;  x  \n4;5;6\n\n'.encode("iso-8859-1"))
    df = delimited.load_table(spark, str(path), ";", encoding="ISO-8859-1")
    assert sorted((r.nom or "", r.ville) for r in df.collect()) == [("", "  x  "), ("Elodie", "Besancon")]
    prof = delimited.load_profile(spark, str(path), ";", encoding="ISO-8859-1").first()
    # the long row and the blank line are malformed
    assert (prof.n_rows, prof.n_malformed) == (2, 2)


LINES = ["nom;valeur", "Zoë;1", "", "漢字;x", "短い", "カ;3", ""]


@pytest.mark.parametrize("encoding", ["UTF-16LE", "UTF-16BE", "UTF-32LE", "UTF-16", "shift_jis",
                                      "euc_jp", "gb18030", "cp932"])
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_multi_byte_files_have_the_profile_of_utf_8(spark, workdir, encoding, end):
    lines = [x.replace("ë", "e") if not encoding.startswith("UTF") else x
             for x in LINES]
    text = end.join(lines) + end
    (workdir / "a.txt").write_bytes(text.encode(encoding))
    (workdir / "b.txt").write_bytes(text.encode("utf-8"))
    a, b = (delimited.load_profile(spark, str(workdir / f), ";", "x", accents=False, encoding=e,
                                   types=["str", "bin"]).collect()
            for f, e in (("a.txt", encoding), ("b.txt", "UTF-8")))
    assert a == b and a[0].n_malformed == 3
    got = delimited.load_table(spark, str(workdir / "a.txt"), ";", accents=False,
                               encoding=encoding).collect()
    assert [r.nom for r in got] == [lines[1].split(";")[0], "漢字", "カ"]


def test_wide_files_are_split_like_others(spark, workdir):
    text = "k;v\n" + "".join(f"{i};é{i}\n" for i in range(5000))
    (workdir / "a.txt").write_bytes(text.encode("utf-16-le"))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "7001")
    try:
        got = delimited.load_table(spark, str(workdir / "a.txt"), ";", {"k": "long"},
                                   accents=False, encoding="UTF-16LE")
        assert got.rdd.getNumPartitions() > 5
        assert got.count() == 5000 and got.where("v <> concat('é', k)").count() == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_a_feed_across_characters_fails_loudly(spark, workdir):
    (workdir / "a.txt").write_bytes("k\n\u0a15\u4e00\n".encode("utf-16-le"))
    with pytest.raises(Exception, match="across two characters"):
        delimited.read_lines(spark, str(workdir / "a.txt"), "UTF-16LE").collect()


@pytest.mark.parametrize("encoding", ["iso2022_jp", "utf-7", "hz"])
def test_charsets_with_shift_states_raise(spark, workdir, encoding):
    (workdir / "a.txt").write_text("x\n")
    with pytest.raises(ValueError):
        delimited.read_lines(spark, str(workdir / "a.txt"), encoding)


def test_utf_16_without_a_mark_asks_for_the_order(spark, workdir):
    (workdir / "a.txt").write_bytes("xy\n".encode("utf-16-le"))
    with pytest.raises(ValueError, match="byte order"):
        delimited.read_lines(spark, str(workdir / "a.txt"), "UTF-16")


def test_fault_examples(spark):
    rows = ["k;n", *[f"{i};x" for i in range(30)], *["only"] * 40, *["7;8;9"], "", "", "1;2"]
    df = spark.createDataFrame([(x,) for x in rows], "value string")
    header = df.limit(1)
    found = []
    for partitions in (1, 5):
        parsed = delimited.parse_lines(df.repartition(partitions), ";", header_source=header)
        found.append(sorted(map(tuple, delimited.fault_examples(
            parsed, ["str", "bin"], k=3).collect()), key=str))
    assert found[0] == found[1]
    by_fault = {}
    for column, fault, rank, line, n in found[0]:
        by_fault.setdefault((column, fault), []).append((rank, line, n))
    assert by_fault[None, "blank"] == [(1, "", 2)]
    assert {x[1:] for x in by_fault[None, "width"]} == {("only", 40), ("7;8;9", 1)}
    first = sorted((f"{i};x" for i in range(30)),
                   key=lambda x: hashlib.md5(x.encode()).hexdigest())[:3]
    assert sorted(by_fault["n", "type"]) == [(i + 1, x, 1) for i, x in enumerate(first)]
    assert set(by_fault) == {(None, "blank"), (None, "width"), ("n", "type")}
