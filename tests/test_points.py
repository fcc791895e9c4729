"""Labelled points from several files, and libsvm text with accounting."""

from __future__ import annotations

import pytest
from pyspark.ml.linalg import SparseVector

from vitrail.sources import points


def lines_of(spark, lines):
    return spark.createDataFrame([(x,) for x in lines], "value string")


def test_header_is_the_first_file_s_first_line(spark, workdir):
    # Spark reads the largest file first: its first line is data that also stands elsewhere
    (workdir / "a.txt").write_text("label x y\n1 2 3\n")
    (workdir / "b.txt").write_text("4 5 6\n" + "1 2 3\n4 5 6\n" * 50)
    got = points.load_labeled_points(spark, str(workdir), drop_header=True, as_vector=False)
    assert got.count() == 102
    assert got.where("label = 4").count() == 51


def test_every_file_may_have_the_header(spark, workdir):
    for name in "ab":
        (workdir / f"{name}.txt").write_text("l;x\n1;2\n")
    got = points.load_labeled_points(spark, str(workdir), sep=";", drop_header=True,
                                     as_vector=False)
    assert [tuple(r) for r in got.collect()] == [(1.0, [2.0])] * 2


def test_numbers_are_no_header(spark):
    got = points.parse_labeled_points(lines_of(spark, ["1 2", "1 2", "3 4"]), drop_header=True,
                                      as_vector=False)
    assert got.count() == 3


def test_a_short_first_line_spoils_nothing(spark):
    tagged = points.tag_labeled_points(lines_of(spark, ["7", "1 2 3", "4 5 6", "1 2 3 4"]))
    assert points.points_profile(tagged).first()[:] == (2, 2)
    assert points.points_profile(points.tag_labeled_points(lines_of(spark, ["", " "]))).first()[
        :] == (0, 0)


LIBSVM = [
    ("1 1:0.5 3:2", None), ("-1.5", None), ("", "skipped"), ("# note", "skipped"),
    ("2 2:1e3 # tail", None), ("  3   1:1  2:2 ", None),
    ("one 1:2", "label"), ("1 1:x", "token"), ("1 x:1", "token"), ("1 7", "token"),
    ("1 1:2:3", "token"), ("1 0:2", "index"), ("1 -4:2", "index"), ("1 9:2", "index"),
    ("1 1:2 1:3", "repeat"), ("1 2:1 1:3 2:4", "repeat"), ("1 2:1 1:3", "order"),
    ("1 1.5:2", "token"), ("x 0:1", "label"),
]


def test_libsvm_faults(spark):
    tagged = points.tag_libsvm(lines_of(spark, [x for x, _ in LIBSVM]), num_features=5)
    got = {r["value"]: r["fault"] for r in tagged.collect()}
    assert got == {x: f for x, f in LIBSVM if f != "skipped"}
    counts = points.libsvm_profile(tagged).first().asDict()
    assert counts == {"n_rows": 4, "n_label": 2, "n_token": 5, "n_index": 3, "n_repeat": 2,
                      "n_order": 1}


def test_libsvm_vectors_equal_the_reader_s(spark, workdir):
    good = ["1 1:0.5 3:2", "-1.5", "2 2:1e3", "3 1:1 2:2 4:-7.25"]
    (workdir / "x.txt").write_text("\n".join(good) + "\n")
    want = {(r.label, r.features) for r in points.read_libsvm(spark, str(workdir / "x.txt"),
                                                              4).collect()}
    got = points.parse_libsvm(lines_of(spark, [*good, "bad 1:1", "9 9:x"]))
    rows = got.collect()
    assert {(r.label, r.features) for r in rows} == want
    assert all(isinstance(r.features, SparseVector) and r.features.size == 4 for r in rows)


@pytest.mark.parametrize("lines", [[], ["", "#"], ["bad"]])
def test_libsvm_without_good_lines(spark, lines):
    assert points.parse_libsvm(lines_of(spark, lines)).count() == 0


def test_size_of_one_feature(spark):
    rows = points.parse_libsvm(lines_of(spark, ["1 1:7", "2"])).collect()
    assert {r.features for r in rows} == {SparseVector(1, {0: 7.0}), SparseVector(1, {})}


def test_profile_gives_the_size(spark):
    def profile(lines):
        return points.libsvm_profile(points.tag_libsvm(lines_of(spark, lines)), with_size=True)
    assert profile([*[x for x, _ in LIBSVM], "1 40:x"]).first().n_features == 9
    assert profile(["bad"]).first().n_features == 0


def test_a_line_is_split_once_and_vectors_need_no_text(spark):
    """the plan held the split of a line four times and a vector's way through JSON."""
    plan = points.parse_libsvm(lines_of(spark, ["1 1:7"]), 1)._jdf.queryExecution()
    text = plan.optimizedPlan().toString()
    assert text.count("split(") == 1 and "json" not in text.lower()
