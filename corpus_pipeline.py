"""The corpus pipeline: five stages over ``documents``, each written as Parquet and reread.

Toxic documents go, then those that fail the quality rules; lines that many documents share
stay in one of them; of each group of near copies one document stays; what is left is
tokenised and packed into sequences.  ``ORACLE_SQL`` is None, as SQL can express neither
the trees nor the tokens.

Defined cases: a null text is empty, and an empty text has too few words for the quality
rules; without labels of both kinds no document is toxic; repeated rows are one document
from the fourth stage on, while documents that share an id and differ in their texts stay
apart; where a stage leaves nothing, the later ones return no rows; columns beyond those of
``documents`` are dropped by the first stage; very long texts are handled whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrail.llm import jaccard_join, line_dedup, packing, quality, toxicity
from vitrail.llm.common import marker, release, table, written

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]

#: Near copies in the pipeline: sets of five words, at least 80 % alike.
NEAR = jaccard_join.Similarity(words=5, percent=80)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: documents predicted toxic go."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return model.score(docs).where("predicted = 0").select(*COLUMNS)


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: documents that the quality rules reject go."""
    return quality.judge(docs).where("kept").select(*COLUMNS)


def drop_shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: the texts lose the lines that stay in another document."""
    left = line_dedup.dedup_lines(docs).withColumn("text", F.col("kept_text"))
    return left.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def keep_one_of_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: of each group of near copies the document with the smallest id stays."""
    return jaccard_join.one_of_each(docs, NEAR).select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: the pieces of all documents, packed into sequences."""
    return packing.pack_production(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("quality", keep_good),
    ("line_dedup", drop_shared_lines),
    ("near_duplicates", keep_one_of_near),
    ("packing", pack),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage; the tables of the others are removed on the way."""
    docs = table(spark, sf_dir, "documents")
    start = marker(spark)
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
        release(spark, start, keep=1)
    return docs
