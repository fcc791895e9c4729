"""Registered queries: each takes ``(spark, sf_dir)`` and returns a DataFrame built from
the driver's tables.  Column names match the SQL oracles in :mod:`vitrail.plans.oracles`;
doubles are rounded (significant digits for statistics, decimals for bounded metrics) so
results compare across engines whatever the summation order."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrail.functions import text
from vitrail.functions.numeric import round_sig, round_to
from vitrail.operators import cluster, describe, graph, metrics, models, numbering, split
from vitrail.session import cut_lineage, remove_path, scratch_path
from vitrail.sources import delimited, points

Query = Callable[[SparkSession, str], DataFrame]

# Numeric lineitem columns used as dense features throughout.
LINEITEM_FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# --------------------------------------------------------------------------- profiling

def q_class_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return (describe.class_distribution(li, "l_returnflag")
            .select("class", "n", round_to("share", 9).alias("share")))


def q_col_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    st = describe.column_stats(li, LINEITEM_FEATURES)
    return st.select(F.col("idx").cast("int").alias("idx"), "feature",
                     F.col("count").cast("bigint").alias("count"),
                     round_sig("mean").alias("mean"), round_sig("variance").alias("variance"),
                     F.col("num_nonzeros").cast("bigint").alias("num_nonzeros"),
                     F.col("min").alias("min"), F.col("max").alias("max"))


def q_corr_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    cm = describe.correlation_matrix(li, LINEITEM_FEATURES)
    return cm.select(F.col("i").cast("int").alias("i"), F.col("j").cast("int").alias("j"),
                     "column_i", "column_j", round_to("corr", 9).alias("corr"))


def q_corr_pairwise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D7 where three of four columns have gaps: every pair over the rows that have both."""
    li = table(spark, sf_dir, "lineitem").select(
        F.when(F.col("l_linenumber") != 7, F.col("l_quantity")).alias("quantity"),
        F.col("l_extendedprice").alias("price"),
        F.when(F.col("l_orderkey") % 7 != 0, F.col("l_discount")).alias("discount"),
        F.when(F.col("l_partkey") % 5 != 0, F.col("l_tax")).alias("tax"))
    cm = describe.pairwise_correlation(li, li.columns)
    return cm.select("i", "j", "column_i", "column_j", "n", round_to("corr", 9).alias("corr"))


def q_describe_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    d = describe.describe_numeric(li, LINEITEM_FEATURES)
    return d.select(F.col("idx").cast("int").alias("idx"), "feature",
                    F.col("count").cast("bigint").alias("count"),
                    round_sig("mean").alias("mean"), round_sig("std").alias("std"),
                    "min", round_sig("q25").alias("q25"), round_sig("q50").alias("q50"),
                    round_sig("q75").alias("q75"), "max")


# --------------------------------------------------------------------------- ingest
# The ingest queries parse text that Spark renders from the whole lineitem table:
# one line per row, the header first and again at the end (two concatenated files), one
# blank line, quoted fields (an empty quoted flag for 'N', a quoted pair holding the
# separator), and rows spoiled on purpose -- a key divisible by 50 loses its last field,
# one divisible by 51 gains one.  Every row is rendered and parsed.

INGEST_NAMES = ["l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount",
                "flag", "status_pair", "ship_day"]
INGEST_TYPES = ["long", "bin", "number", "number", "number", "str", "str", "date"]
SEP = ";"


def _line_key() -> F.Column:
    return F.col("l_orderkey") * 10 + F.col("l_linenumber")


def lineitem_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    q = F.lit('"')
    fields = [
        F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"),
        F.col("l_quantity").cast("string"), F.col("l_extendedprice").cast("string"),
        F.col("l_discount").cast("string"),
        F.when(F.col("l_returnflag") == "N", F.lit('""'))
         .otherwise(F.concat(q, F.col("l_returnflag"), q)),
        F.concat(q, F.col("l_returnflag"), F.lit(SEP), F.col("l_linestatus"), q),
        F.date_format("l_shipdate", "yyyy-MM-dd"),
    ]
    key = _line_key()
    body = li.select(
        F.when(key % 50 == 0, F.concat_ws(SEP, *fields[:-1]))
         .when(key % 51 == 0, F.concat_ws(SEP, *fields, F.lit("extra")))
         .otherwise(F.concat_ws(SEP, *fields)).alias("value"))
    header = spark.createDataFrame([(SEP.join(INGEST_NAMES),)], "value string")
    blank = spark.createDataFrame([("",)], "value string")
    return header.unionAll(body).unionAll(header).unionAll(blank)


def _typed_ingest(df: DataFrame) -> DataFrame:
    return df.select(
        F.col("l_orderkey").cast("bigint").alias("l_orderkey"),
        F.col("l_linenumber").cast("int").alias("l_linenumber"),
        F.col("l_quantity").cast("double").alias("l_quantity"),
        F.col("l_extendedprice").cast("double").alias("l_extendedprice"),
        F.col("l_discount").cast("double").alias("l_discount"),
        "flag", "status_pair", "ship_day")


def q_ingest_delimited(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = delimited.parse_lines(lineitem_lines(spark, sf_dir), SEP)
    return _typed_ingest(delimited.good_rows(parsed))


def q_ingest_malformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = delimited.parse_lines(lineitem_lines(spark, sf_dir), SEP)
    parts = F.split(F.col("value"), SEP)
    return delimited.malformed_rows(parsed).select(
        F.get(parts, 0).try_cast("bigint").alias("l_orderkey"),
        F.get(parts, 1).try_cast("int").alias("l_linenumber"))


def q_ingest_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = delimited.parse_lines(lineitem_lines(spark, sf_dir), SEP)
    return delimited.profile(parsed, "lineitem")


def q_ingest_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delimited.load_lines_table(lineitem_lines(spark, sf_dir), SEP, types=INGEST_TYPES)


def q_ingest_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    loaded = delimited.load_lines_table(lineitem_lines(spark, sf_dir), SEP)
    return loaded.groupBy("flag").agg(F.count(F.lit(1)).alias("n"))


def q_ingest_table_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    loaded = delimited.load_lines_table(lineitem_lines(spark, sf_dir), SEP, types=INGEST_TYPES)
    view = f"ingested_{uuid.uuid4().hex[:12]}"
    loaded.createOrReplaceTempView(view)
    return spark.sql(f"""
        SELECT flag, year(ship_day) AS ship_year, count(*) AS n,
               sum(CAST(l_quantity AS DOUBLE)) AS sum_qty
        FROM {view} GROUP BY flag, year(ship_day)""")


def dirty_lines(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(lines with a header, the header).  A quantity of every tenth order is text, the line
    number of every seventh is too large for its type."""
    li = table(spark, sf_dir, "lineitem")
    key = F.col("l_orderkey")
    lines = li.select(F.concat_ws(
        SEP, key.cast("string"),
        F.when(key % 7 == 0, F.lit("3000000000")).otherwise(F.col("l_linenumber").cast("string")),
        F.when(key % 10 == 0, F.lit("n/a")).otherwise(F.col("l_quantity").cast("string")),
        F.when(key % 3 == 0, F.lit("")).otherwise(F.date_format("l_shipdate", "yyyy-MM-dd")),
    ).alias("value"))
    header = spark.createDataFrame([("key;line;quantity;day",)], "value string")
    return header.unionAll(lines), header


DIRTY_TYPES = ["long", "bin", "number", "date"]


def q_ingest_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A7 + A9: values that their type cannot hold, counted by column."""
    lines, header = dirty_lines(spark, sf_dir)
    parsed = delimited.parse_lines(lines, SEP, header_source=header)
    row = delimited.profile(parsed, "lineitem", DIRTY_TYPES)
    return row.select("n_rows", "n_malformed", F.explode("n_bad").alias("b")).select(
        F.col("b.column").alias("column"), F.col("b.n").alias("n_bad"), "n_rows", "n_malformed")


def q_ingest_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A6 + A7: examples of every fault: the dirty lines, of which each of order 11, 22, ...
    has lost its last field, and a blank one."""
    lines, header = dirty_lines(spark, sf_dir)
    short = F.try_to_number(F.substring_index("value", SEP, 1), F.lit("999999999999")) % 11 == 0
    lines = lines.select(F.when(short, F.substring_index("value", SEP, 3)).otherwise(
        F.col("value")).alias("value"))
    blank = spark.createDataFrame([("",), ("",)], "value string")
    parsed = delimited.parse_lines(lines.unionAll(blank), SEP, header_source=header)
    return delimited.fault_examples(parsed, DIRTY_TYPES, k=5)


# Queries on files: a whole table is written as delimited text below the session's shared
# folder and loaded the way users load theirs; the files go once the result is kept.

FILE_COLUMNS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
                "l_shipdate"]
FILE_TYPES = {"l_orderkey": "long", "l_partkey": "long", "l_suppkey": "long",
              "l_linenumber": "bin", "l_quantity": "double", "l_extendedprice": "double",
              "l_discount": "double", "l_tax": "double", "l_shipdate": "date"}


def _as_files(df: DataFrame, name: str) -> str:
    path = scratch_path(df.sparkSession, name)
    df.write.option("header", "true").option("sep", SEP).csv(path)
    return path


def q_ingest_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select(*FILE_COLUMNS).withColumn(
        "l_shipdate", F.to_date("l_shipdate"))
    path = _as_files(li, "ingest")
    loaded = cut_lineage(delimited.load_table(spark, path, SEP, FILE_TYPES, on_bad="raise"))
    remove_path(spark, path)
    return loaded


def q_ingest_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _as_files(table(spark, sf_dir, "customer"), "header")
    names = delimited.column_names(
        delimited.header_of(delimited.first_file_lines(spark, path), SEP))
    remove_path(spark, path)
    return spark.createDataFrame(list(enumerate(names)), "position int, name string")


def q_ingest_charset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1: the lines of the ingest queries written as UTF-16, blank line included, have the
    profile that they have as UTF-8."""
    path = scratch_path(spark, "utf16")
    raw = F.encode("value", "UTF-16LE").cast("string")  # its bytes, written as they are
    lineitem_lines(spark, sf_dir).select(raw.alias("value")).write.option(
        "encoding", "UTF-16LE").option("lineSep", "\n").text(path)
    lines = delimited.read_lines(spark, path, "UTF-16LE")
    header = spark.createDataFrame([(SEP.join(INGEST_NAMES),)], "value string")
    found = cut_lineage(delimited.profile(
        delimited.parse_lines(lines, SEP, header_source=header), "lineitem"))
    remove_path(spark, path)
    return found


POINT_COLUMNS = ["l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
                 "l_discount", "l_tax", "l_returnflag", "l_linenumber"]


def q_parse_points_semicolon(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight features, then the label, separated by semicolons, under a header."""
    li = table(spark, sf_dir, "lineitem").withColumn(
        "l_returnflag", F.ascii("l_returnflag")).select(*POINT_COLUMNS)
    path = _as_files(li, "points")
    lines = delimited.read_lines(spark, path)
    out = cut_lineage(points.parse_labeled_points(
        lines, SEP, label_index=8, as_vector=False, drop_header=True))
    remove_path(spark, path)
    return out


def q_parse_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    lines = li.select(F.concat_ws(" ", *[F.col(c).cast("string") for c in
                                         ["l_linenumber", "l_quantity", "l_discount", "l_tax"]])
                      .alias("value"))
    return points.parse_labeled_points(lines, " ", label_index=0, as_vector=False)


def q_strip_accents(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    folded = text.strip_accents("text")
    return docs.select("doc_id", F.length(folded).cast("bigint").alias("n_chars"),
                       F.md5(folded).alias("md5"))


def _labelled_points(li: DataFrame) -> DataFrame:
    return li.select(F.col("l_linenumber").cast("double").alias("label"),
                     array_to_vector(F.array("l_quantity", "l_discount", "l_tax")).alias("features"))


def q_libsvm_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "libsvm")
    points.write_libsvm(_labelled_points(table(spark, sf_dir, "lineitem")), path)
    back = points.read_libsvm(spark, path, num_features=3)
    out = cut_lineage(back.select("label", vector_to_array("features").alias("features")))
    remove_path(spark, path)
    return out


def q_libsvm_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines as libsvm text, of which some orders are spoiled in one way each; what
    was wrong is counted, and the good lines' values are added up from their vectors."""
    li, key = table(spark, sf_dir, "lineitem"), F.col("l_orderkey") % 20
    q, d, t = (F.col(c).cast("string") for c in ("l_quantity", "l_discount", "l_tax"))
    label = F.when(key == 1, F.lit("one")).otherwise(F.col("l_linenumber").cast("string"))
    first = F.when(key == 2, F.lit("0:")).when(key == 3, F.lit("4:")).otherwise(F.lit("1:"))
    third = F.when(key == 4, F.lit("2:")).otherwise(F.lit("3:"))
    lines = li.select(F.concat(
        label, F.lit(" "), first, q, F.lit(" 2:"), F.when(key == 5, F.lit("x")).otherwise(d),
        F.lit("  "), third, t, F.when(key == 6, F.lit(" # of order six")).otherwise(F.lit(""))
    ).alias("value")).unionAll(spark.createDataFrame([("",), ("# no point",)], "value string"))
    counts = points.libsvm_profile(points.tag_libsvm(lines), with_size=True).first()  # one row
    good = points.parse_libsvm(lines, counts["n_features"]).select("label", vector_to_array("features").alias("x"))
    return good.groupBy("label").agg(
        F.count(F.lit(1)).alias("n"), *[round_sig(F.sum(F.col("x")[i])).alias(f"x{i}")
                                        for i in range(3)]).select("*", *[
            F.lit(counts[f"n_{f}"]).alias(f"n_{f}") for f in points.LIBSVM_FAULTS])


def q_zip_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels and predictions written apart, in files of different number and size, are
    paired line by line and tabled."""
    li = table(spark, sf_dir, "lineitem")
    keys = [F.col(c) for c in SPLIT_COLUMNS]
    scored = li.select(*SPLIT_COLUMNS, F.col("l_linenumber").cast("string").alias("label"),
                       (F.floor((F.col("l_quantity") - 1) / 10) + 1).cast("string").alias("p"))
    paths = [scratch_path(spark, "zip"), scratch_path(spark, "zip")]
    rows = li.count()
    for path, column, least, size in zip(paths, ("label", "p"), (5, 3), (1, 0.6)):
        files = numbering.parts_for(int(size * rows), least)
        scored.select(*SPLIT_COLUMNS, column).repartitionByRange(
            files, *keys).sortWithinPartitions(*keys).select(
            F.col(column).alias("value")).write.text(path)
    labels, found = (numbering.file_order(spark.read.text(p)) for p in paths)
    paired = numbering.pair_rows(labels.withColumnRenamed("value", "label"),
                                 found.withColumnRenamed("value", "prediction"))
    out = cut_lineage(metrics.confusion_matrix(paired.select(
        F.col("label").cast("int").alias("label"), F.col("prediction").cast("int").alias(
            "prediction"))))
    for path in paths:
        remove_path(spark, path)
    return out


# --------------------------------------------------------------------------- splits

LINE_KEYS = ["l_orderkey", "l_linenumber"]


def q_hash_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select(*LINE_KEYS)
    return split.hash_split_tag(li, LINE_KEYS, (0.6, 0.4))


SPLIT_COLUMNS = [*LINE_KEYS, "l_partkey", "l_quantity", "l_extendedprice"]


def q_random_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What holds of any right split: every row is in one part, none in both, the
    shares are about the weights, and another partitioning gives the same parts."""
    li = table(spark, sf_dir, "lineitem").select(*SPLIT_COLUMNS)
    train, test = split.random_split(li, (0.6, 0.4), seed=0)
    again, _ = split.random_split(li.repartition(7), (0.6, 0.4), seed=0)
    parts = train.select("*", F.lit(0).alias("p"), F.lit(0).alias("r")).unionAll(
        test.select("*", F.lit(1).alias("p"), F.lit(0).alias("r"))).unionAll(
        again.select("*", F.lit(0).alias("p"), F.lit(1).alias("r")))
    first = F.col("r") == 0
    rows = parts.groupBy(*SPLIT_COLUMNS).agg(
        F.count_if(first).alias("n"), F.count_if(first & (F.col("p") == 0)).alias("n0"),
        F.count_if(F.col("r") == 1).alias("n2"))
    return rows.agg(
        F.sum("n").alias("n"), F.count_if((F.col("n0") > 0) & (F.col("n0") < F.col("n")))
        .alias("n_in_both"), F.count_if(F.col("n0") != F.col("n2")).alias("n_moved"),
        (F.abs(F.sum("n0") / F.sum("n") - 0.6) < 0.05).alias("share_holds"))


def q_sample_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sample's rows are the table's, about a tenth of them, and the same for
    another partitioning."""
    li = table(spark, sf_dir, "lineitem").select(*SPLIT_COLUMNS)
    one = split.sample_rows(li, 0.1, seed=0)
    two = split.sample_rows(li.repartition(7), 0.1, seed=0)
    rows = li.select("*", F.lit(0).alias("r")).unionAll(one.select("*", F.lit(1).alias("r"))) \
        .unionAll(two.select("*", F.lit(2).alias("r"))).groupBy(*SPLIT_COLUMNS).agg(
        *[F.count_if(F.col("r") == i).alias(f"n{i}") for i in range(3)])
    return rows.agg(
        F.sum("n0").alias("n"), F.count_if(F.col("n1") > F.col("n0")).alias("n_invented"),
        F.count_if(F.col("n1") != F.col("n2")).alias("n_moved"),
        (F.abs(F.sum("n1") / F.sum("n0") - 0.1) < 0.03).alias("share_holds"))


def repeated_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines as one column ``k``; a third of them are one and the same row, and those of
    an order and part of the rest are equal where quantities are."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(F.when(F.col("l_orderkey") % 3 == 0, F.lit("hot")).otherwise(
        F.concat_ws("-", (F.col("l_orderkey") % 100).cast("string"),
                    F.floor("l_quantity").cast("string"))).alias("k"))


def q_sample_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E1 on a table of which a third is one row: what the sample keeps of every value, by
    draws that SQL repeats exactly."""
    rows = repeated_rows(spark, sf_dir)
    kept = split.sample_rows(rows, 0.1, seed=5, method="md5").groupBy("k").agg(
        F.count(F.lit(1)).alias("n_kept"))
    return rows.groupBy("k").agg(F.count(F.lit(1)).alias("n")).join(kept, "k", "left").select(
        "k", "n", F.coalesce("n_kept", F.lit(0)).alias("n_kept"))


def q_split_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E2/E3 on the same table: three parts, counted by value."""
    tagged = split.random_split_tag(repeated_rows(spark, sf_dir), (0.6, 0.3, 0.1), seed=6,
                                    method="md5")
    return tagged.groupBy("k").agg(*[
        F.count_if(F.col("split") == i).alias(f"n{i}") for i in range(3)])


# --------------------------------------------------------------------------- metrics
# Model-free scoring so every metric has a closed form: the label is the line number
# (1..7), the prediction a quantity band (1..5), so two classes are never predicted.

def rule_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(F.col("l_linenumber").cast("int").alias("label"),
                     (F.floor((F.col("l_quantity") - 1) / 10) + 1).cast("int").alias("prediction"))


def q_confusion_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.confusion_matrix(rule_scored(spark, sf_dir))


def q_confusion_one_vs_rest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.one_vs_rest(metrics.confusion_matrix(rule_scored(spark, sf_dir)))


def _round_metrics(df: DataFrame, cols: list[str], keep: list[str]) -> DataFrame:
    return df.select(*keep, *[round_to(c, 9).alias(c) for c in cols])


def q_metrics_per_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    pc = metrics.per_class_metrics(
        metrics.one_vs_rest(metrics.confusion_matrix(rule_scored(spark, sf_dir))))
    return _round_metrics(pc, ["precision", "recall", "f1"], ["class", "tp", "fp", "fn"])


def q_metrics_macro(spark: SparkSession, sf_dir: str) -> DataFrame:
    pc = metrics.per_class_metrics(
        metrics.one_vs_rest(metrics.confusion_matrix(rule_scored(spark, sf_dir))))
    return _round_metrics(metrics.macro_summary(pc, "quantity band"),
                          ["precision", "recall", "f_measure"], ["method"])


def q_accuracy_error(spark: SparkSession, sf_dir: str) -> DataFrame:
    acc = metrics.accuracy(rule_scored(spark, sf_dir))
    return _round_metrics(acc, ["accuracy", "error"], ["n", "n_correct"])


def q_multilabel_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    sets = ev.groupBy("user_id").agg(
        F.collect_set("event_type").alias("label"),
        F.collect_set(F.when(F.col("value") > 50, F.col("event_type"))).alias("prediction"))
    m = metrics.multilabel_metrics(sets)
    return _round_metrics(m, ["precision", "recall", "f1", "accuracy"], ["n"])


# --------------------------------------------------------------------------- models
# Supervised queries on lineitem.  Its columns are independent, so labels are derived
# with a signal: a quantity band (5 classes), a quantity tercile (3), quantity > 25 (2).
# Splits hash the line key, so they are the same in Spark and in SQL.

NB_FEATURES = ["l_quantity", "l_discount", "l_tax"]
TREE_FEATURES = ["l_quantity", "l_discount", "l_tax", "l_extendedprice"]
SMALL_FEATURES = ["l_quantity", "l_discount", "l_tax", "l_linenumber"]


def banded(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        *LINE_KEYS, "l_quantity", "l_discount", "l_tax", "l_extendedprice",
        F.floor((F.col("l_quantity") - 1) / 10).cast("int").alias("band"),
        F.floor((F.col("l_quantity") - 1) / 17).cast("int").alias("tercile"),
        (F.col("l_quantity") > 25).cast("int").alias("big"))


def _train_test(df: DataFrame, weights=(0.6, 0.4)) -> tuple[DataFrame, DataFrame]:
    train, test = split.hash_split(df, LINE_KEYS, weights)
    return train, test


def _nb(spark: SparkSession, sf_dir: str):
    data = banded(spark, sf_dir)
    train, test = _train_test(data)
    clf = models.fit_classifier(train, models.naive_bayes(1.0), "band", NB_FEATURES)
    return clf, test


def q_nb_parameters(spark: SparkSession, sf_dir: str) -> DataFrame:
    clf, _ = _nb(spark, sf_dir)
    rows = models.naive_bayes_parameters(clf)
    df = spark.createDataFrame(rows, "label string, feature int, log_prior double, "
                                     "log_likelihood double")
    return df.select(F.col("label").cast("int").alias("label"), "feature",
                     round_sig("log_prior").alias("log_prior"),
                     round_sig("log_likelihood").alias("log_likelihood"))


def q_nb_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    clf, test = _nb(spark, sf_dir)
    return metrics.confusion_matrix(clf.transform(test), "band", "prediction")


def q_show_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E5: the first five scored test rows in a stable order (the original showed five
    example predictions).  ``orderBy + limit`` is a per-partition top-k and a merge of
    k rows per task, not a sort of the whole table."""
    clf, test = _nb(spark, sf_dir)
    scored = clf.transform(test).select(*LINE_KEYS, *NB_FEATURES, F.col("band").alias("label"),
                                        "prediction")
    return scored.orderBy(*LINE_KEYS, *NB_FEATURES).limit(5)


def q_index_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events").select("event_id", "event_type")
    indexer = models.index_labels(ev, "event_type", order="frequencyDesc", output="idx")
    return indexer.transform(ev)


def q_index_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = banded(spark, sf_dir)
    model, _ = models.index_features(data, SMALL_FEATURES, max_categories=10)
    return spark.createDataFrame(models.category_maps(model),
                                 "feature int, value double, category int")


def q_dt_stump(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_discount")
    clf = models.fit_classifier(li, models.decision_tree("entropy", 1, 32), "l_returnflag",
                                ["l_discount"])
    return metrics.confusion_matrix(clf.transform(li), "l_returnflag", "prediction")


def q_tree_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stump as text, line by line under its title."""
    clf = models.fit_classifier(banded(spark, sf_dir), models.decision_tree("entropy", 1, 64),
                                "big", ["l_quantity"])
    lines = [x.strip() for x in models.tree_debug_string(clf).strip().split("\n")[1:]]
    return spark.createDataFrame(list(enumerate(lines)), "line int, text string")


def q_nb_one_based(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels 1 and 2 come back as 1 and 2."""
    data = banded(spark, sf_dir).withColumn("half", F.col("big") + 1)
    train, test = _train_test(data)
    clf = models.fit_classifier(train, models.naive_bayes(1.0), "half", NB_FEATURES)
    return metrics.confusion_matrix(clf.transform(test), "half", "prediction")


def q_lr_saturated(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select(
        (F.col("l_linestatus") == "F").cast("double").alias("is_f"),
        (F.col("l_linestatus") == "O").cast("double").alias("is_o"),
        (F.col("l_returnflag") == "R").cast("double").alias("y"))
    clf = models.fit_classifier(li, models.logistic_lbfgs(), "y", ["is_f", "is_o"])
    rows = [(j, c) for j, c, _ in models.linear_coefficients(clf)]
    return spark.createDataFrame(rows, "feature int, coefficient double").select(
        "feature", round_to("coefficient", 4).alias("coefficient"))


# The fits below have no closed form.  Their queries return, for every label, how many rows
# were scored, how many predictions are labels at all, and whether the error stays below a
# bound that a wrong label map, split or feature order breaks.

def _judged(clf, rows: DataFrame, label: str, most: float) -> DataFrame:
    scored = clf.transform(rows).select(F.col(label).alias("label"), "prediction")
    labels = [F.lit(x).cast("int") for x in clf.labels]
    return scored.groupBy("label").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("prediction").isin(*labels))
        .alias("n_in_label_space"),
        (F.avg((F.col("label") != F.col("prediction")).cast("double")) <= most)
        .alias("error_holds"))


def q_dt_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test = _train_test(banded(spark, sf_dir))
    clf = models.fit_classifier(train, models.decision_tree("entropy", 10, 32), "band",
                                TREE_FEATURES)
    return _judged(clf, test, "band", 0.2)


def q_dt_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With a bin for every quantity the tree finds the bands exactly."""
    train, test = _train_test(banded(spark, sf_dir))
    clf = models.fit_classifier(train, models.decision_tree("entropy", 10, 64), "band",
                                ["l_quantity", "l_discount"])
    return metrics.confusion_matrix(clf.transform(test), "band", "prediction")


def q_gbt_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = banded(spark, sf_dir)
    train, test = _train_test(data, (0.7, 0.3))
    clf = models.fit_classifier(train, models.gradient_boosted_trees(10, seed=11), "big",
                                SMALL_FEATURES, label_source=data, max_categories=4,
                                label_order="frequencyDesc")
    return _judged(clf, test, "big", 0.05)


def q_gbt_stump(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One round of depth one cuts where the variance falls most."""
    data = banded(spark, sf_dir).withColumn(
        "late", (F.col("l_discount") * 100 + F.col("l_quantity") > 40).cast("int"))
    stump = models.gradient_boosted_trees(1, seed=11).setMaxDepth(1).setMaxBins(64)
    clf = models.fit_classifier(data, stump, "late", ["l_quantity"])
    return metrics.confusion_matrix(clf.transform(data), "late", "prediction")


def q_rf_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = banded(spark, sf_dir)
    train, test = _train_test(data, (0.7, 0.3))
    clf = models.fit_classifier(train, models.random_forest(seed=12), "band",
                                SMALL_FEATURES, label_source=data, max_categories=4,
                                label_order="frequencyDesc")
    return _judged(clf, test, "band", 0.2)


def q_gbt_unseen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """line numbers above 4 are categories that the training set lacks; by line
    number, all rows are scored, and those with a new number are counted as such."""
    data = banded(spark, sf_dir)
    clf = models.fit_classifier(data.where("l_linenumber <= 4"),
                                models.gradient_boosted_trees(10, seed=11), "big",
                                SMALL_FEATURES, max_categories=8)
    scored = clf.transform(data).groupBy("l_linenumber").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("prediction").isin(0, 1)).alias("n_scored"),
        (F.avg((F.col("big") != F.col("prediction")).cast("double")) <= 0.05).alias("error_holds"))
    unseen = {r["feature"]: r["n_unseen"] for r in clf.unseen(data).collect()}
    return scored.withColumn("n_unseen", F.lit(unseen["l_linenumber"]).cast("long"))


def q_rf_one_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A forest of one whole tree over all rows and features is the decision tree."""
    data = banded(spark, sf_dir)
    # one seed: it also picks the rows from which both take their split candidates
    whole = models.random_forest(1, seed=0, featureSubsetStrategy="all", subsamplingRate=1.0,
                                 bootstrap=False, impurity="entropy", maxDepth=10, maxBins=32)
    forest = models.fit_classifier(data, whole, "band", TREE_FEATURES)
    tree = models.fit_classifier(data, models.decision_tree("entropy", 10, 32, seed=0), "band",
                                 TREE_FEATURES)
    one = forest.transform(data).select(*data.columns, F.col("prediction").alias("p1"))
    return tree.transform(one).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("p1") == F.col("prediction")).alias("n_same"))


def q_mlp_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = banded(spark, sf_dir)
    train, test = _train_test(data)
    clf = models.fit_classifier(train, models.perceptron([4, 5, 4, 3], 100, 128, 1234),
                                "tercile", SMALL_FEATURES, label_source=data)
    return _judged(clf, test, "tercile", 0.02)


def q_lr_elastic_net(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For every feature, whether the fit meets the optimality conditions of its
    objective: the slope of the loss in the standardised feature balances the penalties, or
    lies within the l1 penalty where the coefficient is 0."""
    reg, mix, near = 0.3, 0.8, 1e-3
    data = banded(spark, sf_dir)
    clf = models.fit_classifier(data, models.logistic_elastic_net(10, reg, mix), "big",
                                SMALL_FEATURES)
    coefficients = models.linear_coefficients(clf)
    margin = F.lit(coefficients[0][2])
    for j, w, _ in coefficients:
        margin = margin + F.lit(w) * F.col(SMALL_FEATURES[j])
    excess = 1 / (1 + F.exp(-margin)) - F.col("big")
    row = data.agg(F.count(F.lit(1)).alias("n"), *[
        F.stddev_samp(c).alias(f"s{j}") for j, c in enumerate(SMALL_FEATURES)], *[
        F.avg(excess * F.col(c)).alias(f"g{j}") for j, c in enumerate(SMALL_FEATURES)]).first()
    rows = []
    for j, w, _ in coefficients:
        slope, scaled = row[f"g{j}"] / row[f"s{j}"], w * row[f"s{j}"]
        pull = slope + reg * (1 - mix) * scaled
        best = abs(pull) <= reg * mix + near if w == 0 else abs(
            pull + reg * mix * (1 if w > 0 else -1)) <= near
        rows.append((j, row["n"], best))
    return spark.createDataFrame(rows, "feature int, n long, optimal boolean")


def q_svm_linear(spark: SparkSession, sf_dir: str) -> DataFrame:
    # explicit feature list: three of the four columns, as the original SVM cell did; the
    # label is a half space through the origin, which a fit without intercept can find
    data = banded(spark, sf_dir).withColumn(
        "cheap", (F.col("l_quantity") > F.col("l_discount") * 500).cast("int"))
    clf = models.fit_classifier(data, models.linear_svm(100, 0.01, False), "cheap",
                                ["l_quantity", "l_discount", "l_tax"])
    return _judged(clf, data, "cheap", 0.01)


def q_model_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = banded(spark, sf_dir)
    clf = models.fit_classifier(data, models.logistic_lbfgs(), "big", SMALL_FEATURES)
    path = scratch_path(spark, "model")
    clf.save(path)
    loaded = models.Classifier.load(path)
    remove_path(spark, path)
    # score with both models in one pass: the line key is not unique, so no join
    first = clf.transform(data).select(*data.columns, F.col("prediction").alias("p1"))
    both = loaded.transform(first).withColumnRenamed("prediction", "p2")
    return both.agg(F.count(F.lit(1)).alias("n"),
                    F.count_if(F.col("p1") == F.col("p2")).alias("n_same"),
                    (F.avg((F.col("big") != F.col("p1")).cast("double")) < 0.2)
                    .alias("error_holds"))


# --------------------------------------------------------------------------- clustering

def _embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    emb = table(spark, sf_dir, "embeddings")
    return cluster.to_vector(emb, "embedding")


def _assigned(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, list]:
    emb = _embeddings(spark, sf_dir)
    centres = cluster.centres_by_label(emb, "label")
    ids = [int(lab) for lab, _ in centres]
    assigned = cluster.assign_nearest(emb, "embedding", [c for _, c in centres], ids)
    return assigned, ids


def q_assign_nearest_centroid(spark: SparkSession, sf_dir: str) -> DataFrame:
    assigned, _ = _assigned(spark, sf_dir)
    return assigned.select("vec_id", "label", "cluster", round_to("distance", 6).alias("distance"))


def q_assign_many(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C2/H2 with many centres: the means of 97 groups of vectors."""
    emb = _embeddings(spark, sf_dir).withColumn("g", F.pmod("vec_id", F.lit(97)).cast("int"))
    centres = cluster.centres_by_label(emb, "g")
    assigned = cluster.assign_nearest(emb, "embedding", [c for _, c in centres],
                                      [int(g) for g, _ in centres])
    return assigned.select("vec_id", "cluster", round_to("distance", 6).alias("distance"))


def q_wssse(spark: SparkSession, sf_dir: str) -> DataFrame:
    assigned, _ = _assigned(spark, sf_dir)
    s = cluster.distance_sums(assigned)
    return s.select("n", round_sig("sum_distance").alias("sum_distance"),
                    round_sig("sum_sq_distance").alias("sum_sq_distance"))


def q_cluster_label_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    assigned, _ = _assigned(spark, sf_dir)
    return cluster.cluster_label_counts(assigned, "cluster", "label")


def q_cluster_crosstab(spark: SparkSession, sf_dir: str) -> DataFrame:
    assigned, ids = _assigned(spark, sf_dir)
    return cluster.crosstab(assigned, "cluster", "label", ids, clusters=ids)


def q_kmeans_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H1: the best of ten restarts.  All rows are assigned, the sum of squared distances to
    the model's centres is its cost or, as the last step moves them once more, a little
    less, and no single restart is better."""
    emb = _embeddings(spark, sf_dir)
    model, cost = cluster.kmeans_best_of(emb, k=6, max_iter=10, runs=10, init_mode="random")
    _, first = cluster.kmeans_best_of(emb, k=6, max_iter=10, runs=1, init_mode="random")
    centres = [list(map(float, c)) for c in model.clusterCenters()]
    sums = cluster.distance_sums(cluster.assign_nearest(emb, "embedding", centres))
    return sums.select("n", F.lit(len(centres)).alias("k"),
                       F.col("sum_sq_distance").between(0.95 * cost, (1 + 1e-6) * cost)
                       .alias("cost_holds"),
                       F.lit(bool(cost <= first)).alias("best_holds"))


def _gmm_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(array_to_vector(F.array(
        *[F.col(c).cast("double") for c in LINEITEM_FEATURES])).alias("features"))


def q_gmm_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H4: a mixture over all numeric columns: six weights that share out all rows, means
    within the data, symmetric covariances."""
    data = _gmm_points(spark, sf_dir)
    model = cluster.gaussian_mixture(data, k=6, seed=7)
    found = cluster.mixture_components(model)
    total = sum(w for _, w, _, _ in found)
    even = all(abs(c[i][j] - c[j][i]) <= 1e-9 * (1 + abs(c[i][j]))
               for _, _, _, c in found for i in range(len(c)) for j in range(len(c)))
    li = table(spark, sf_dir, "lineitem")
    ends = li.agg(F.count(F.lit(1)).alias("rows"), *[f(c).alias(f"{f.__name__}{j}") for f in (
        F.min, F.max) for j, c in enumerate(LINEITEM_FEATURES)])
    within = F.lit(True)
    for _, _, mean, _ in found:
        for j, m in enumerate(mean):
            slack = 1e-9 * (1 + abs(m))
            within = within & F.lit(float(m)).between(F.col(f"min{j}") - slack,
                                                      F.col(f"max{j}") + slack)
    return ends.select(F.round(F.col("rows") * F.lit(total)).cast("bigint").alias("n"),
                       F.lit(len(found)).alias("k"), F.lit(len(found[0][2])).alias("d"),
                       F.lit(even).alias("symmetric"), within.alias("means_within"))


def q_gmm_moments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H4: the mixture's mean and covariance are those of the data.  Eight digits of means and
    variances: the fifth of a mean can lie on a rounding boundary."""
    model = cluster.gaussian_mixture(_gmm_points(spark, sf_dir), k=6, seed=7)
    mean, cov = cluster.mixture_moments(model)
    dims = len(LINEITEM_FEATURES)
    rows = [(i, j, float(mean[i]), float(cov[i][i]), float(cov[i][j]))
            for i in range(dims) for j in range(dims)]
    df = spark.createDataFrame(rows, "i int, j int, mean_i double, var_i double, cov_ij double")
    # a covariance of independent columns is near 0; compare it on the scale of both columns
    scale = {(r[0], r[1]): (cov[r[0]][r[0]] * cov[r[1]][r[1]]) ** 0.5 for r in rows}
    scaled = F.create_map(*[x for (i, j), v in scale.items() for x in (
        F.lit(i * dims + j), F.lit(float(v)))])
    return df.select("i", "j", round_sig("mean_i", 8).alias("mean_i"), round_sig(
        "var_i", 8).alias("var_i"), round_to(
        F.col("cov_ij") / scaled[F.col("i") * dims + F.col("j")], 4).alias("cov_ij"))


# --------------------------------------------------------------------------- graph
# Similarity graph from lineitem: parts and suppliers are vertices (part p -> 2p,
# supplier s -> 2s + 1), weighted by the number of lines between them.  Linear in the
# table: one aggregate, no pairs within a group.

def part_supplier_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return (li.groupBy((F.col("l_partkey") * 2).alias("src"),
                       (F.col("l_suppkey") * 2 + 1).alias("dst"))
              .agg(F.count(F.lit(1)).cast("double").alias("weight")))


def q_pic_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = graph.edges_to_lines(part_supplier_edges(spark, sf_dir))
    return graph.normalise_edges(points.parse_edges(lines, " "))


def planted_blocks(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(edges, places): the customers in the order of their keys, which may have gaps, are
    numbered; the first quarter and the rest are blocks, inside which a place is tied to
    those 1, 2, 4, 8, ... places on (n log n edges, all of weight 1); one weak edge joins
    the blocks.  The pairs are unique."""
    places = numbering.number_rows(
        table(spark, sf_dir, "customer").select("c_custkey"), ["c_custkey"], "at")
    n = places.count()
    cut = n // 4
    low = F.col("at") < cut
    rows = places.select("at", F.when(low, 0).otherwise(cut).cast("long").alias("start"),
                         F.when(low, cut).otherwise(n - cut).cast("long").alias("size"))
    steps = F.filter(F.array(*[F.lit(1 << j) for j in range(40)]),
                     lambda x: 2 * x < F.col("size"))
    ring = rows.select("at", "start", "size", F.explode(steps).alias("step")).select(
        F.col("at").alias("src"),
        (F.col("start") + (F.col("at") - F.col("start") + F.col("step")) % F.col("size"))
        .alias("dst"), F.lit(1.0).alias("weight"))
    bridge = places.where("at = 0").select(
        F.col("at").alias("src"), F.lit(cut).cast("long").alias("dst"),
        F.lit(0.001).alias("weight"))
    return ring.unionAll(bridge), places


def q_pic_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H5: the planted blocks come back, each under the name of its first customer."""
    edges, places = planted_blocks(spark, sf_dir)
    found = graph.name_by_smallest(graph.power_iteration_clusters(
        edges, k=2, max_iter=10, init_mode="degree"))
    named = found.join(places.select(F.col("at").alias("id"), F.col("c_custkey").alias("key")),
                       "id").join(places.select(F.col("at").alias("cluster"),
                                                F.col("c_custkey").alias("name")), "cluster")
    return graph.describe_assignments(named.select(F.col("key").alias("id"),
                                                   F.col("name").alias("cluster")))


def q_edges_dropped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edge lines with broken ids, loops and weights of 0, accounted for."""
    li = table(spark, sf_dir, "lineitem")
    key = F.col("l_orderkey") + F.lit(9007199254740993)
    lines = li.select(F.concat_ws(
        " ", F.when(F.col("l_orderkey") % 11 == 0, F.lit("x")).otherwise(key.cast("string")),
        F.when(F.col("l_orderkey") % 5 == 0, key).otherwise(F.col("l_partkey")).cast("string"),
        F.when(F.col("l_linenumber") == 1, F.lit("0")).otherwise(F.lit("1.5")))
        .alias("value"))
    good = points.parse_edges(lines)

    def rows(found: DataFrame) -> DataFrame:
        return found.select(F.explode(F.array(*[
            F.struct(F.lit(c).alias("what"), F.col(c).cast("bigint").alias("n"))
            for c in found.columns])).alias("e")).select("e.*")

    return rows(points.points_profile(points.tag_edges(lines))).unionAll(
        rows(graph.dropped_edges(good))).unionAll(
        rows(good.agg(F.max("src").alias("max_src"))))


# --------------------------------------------------------------------------- registry

def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """hash split -> Naive Bayes pipeline -> macro precision / recall / F-measure."""
    clf, test = _nb(spark, sf_dir)
    return metrics.summarize(clf.transform(test), "Naive Bayes", "band", "prediction")


def registry() -> dict[str, Query]:
    return {
        "class_distribution": q_class_distribution,
        "col_stats": q_col_stats,
        "corr_matrix": q_corr_matrix,
        "corr_pairwise": q_corr_pairwise,
        "describe_numeric": q_describe_numeric,
        "ingest_delimited": q_ingest_delimited,
        "ingest_file": q_ingest_file,
        "ingest_header": q_ingest_header,
        "ingest_dirty": q_ingest_dirty,
        "ingest_examples": q_ingest_examples,
        "ingest_charset": q_ingest_charset,
        "ingest_malformed": q_ingest_malformed,
        "ingest_profile": q_ingest_profile,
        "ingest_typed": q_ingest_typed,
        "ingest_nulls": q_ingest_nulls,
        "ingest_table_sql": q_ingest_table_sql,
        "parse_points": q_parse_points,
        "parse_points_semicolon": q_parse_points_semicolon,
        "strip_accents": q_strip_accents,
        "libsvm_roundtrip": q_libsvm_roundtrip,
        "libsvm_dirty": q_libsvm_dirty,
        "zip_predictions": q_zip_predictions,
        "hash_split": q_hash_split,
        "random_split": q_random_split,
        "sample_rows": q_sample_rows,
        "sample_copies": q_sample_copies,
        "split_copies": q_split_copies,
        "confusion_matrix": q_confusion_matrix,
        "confusion_one_vs_rest": q_confusion_one_vs_rest,
        "metrics_per_class": q_metrics_per_class,
        "metrics_macro": q_metrics_macro,
        "accuracy_error": q_accuracy_error,
        "multilabel_metrics": q_multilabel_metrics,
        "index_label": q_index_label,
        "index_features": q_index_features,
        "nb_parameters": q_nb_parameters,
        "nb_classify": q_nb_classify,
        "show_predictions": q_show_predictions,
        "nb_one_based": q_nb_one_based,
        "dt_stump": q_dt_stump,
        "tree_text": q_tree_text,
        "lr_saturated": q_lr_saturated,
        "dt_classify": q_dt_classify,
        "dt_exact": q_dt_exact,
        "gbt_classify": q_gbt_classify,
        "gbt_stump": q_gbt_stump,
        "gbt_unseen": q_gbt_unseen,
        "rf_classify": q_rf_classify,
        "rf_one_tree": q_rf_one_tree,
        "mlp_classify": q_mlp_classify,
        "lr_elastic_net": q_lr_elastic_net,
        "svm_linear": q_svm_linear,
        "model_roundtrip": q_model_roundtrip,
        "assign_nearest_centroid": q_assign_nearest_centroid,
        "assign_many": q_assign_many,
        "wssse": q_wssse,
        "cluster_label_counts": q_cluster_label_counts,
        "cluster_crosstab": q_cluster_crosstab,
        "kmeans_fit": q_kmeans_fit,
        "gmm_fit": q_gmm_fit,
        "gmm_moments": q_gmm_moments,
        "pic_edges": q_pic_edges,
        "pic_clusters": q_pic_clusters,
        "edges_dropped": q_edges_dropped,
    }
