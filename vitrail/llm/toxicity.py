"""Toxicity: gradient-boosted trees over dense features, with isotonic calibration.

The labelled rows whose ``crc32(doc_id) mod 5`` is not 0 may be learned from.  A bounded
sample of them (``max_training`` rows at most, drawn by label, those with the smallest
hashes; weights restore the true share of each label) is dealt into ``folds``, each label
evenly.  The lexicon (words and word beginnings far more frequent in toxic texts) and the
trees are learned from all folds; the features that teach the trees come from lexicons of
the other folds, and the calibration learns from margins of trees of the other folds, so
that no row is judged by what has learned its own label by heart.  Every text is then
turned into the same dense features inside one Arrow function and scored by the trees in
the JVM.

Defined cases: null and empty texts have zero features and get the score of those; a very
long text is measured whole, in a few bytes of memory for each of its own; rows with a null
``doc_id`` are held out; repeated label rows count once, the larger label wins;
with fewer than two rows of either label nothing can be learned and held against the rest,
so that there is no model, a warning is given and all scores are 0; other columns pass
through, and the added ones replace columns of the same name.
"""

from __future__ import annotations

import math
import re
import warnings
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from vitrail.llm.common import bounded_batches, carried, packed, table, text_of, unpacked, written

#: Pronouns of the second person in the four languages.
SECOND_PERSON = ["you", "your", "yours", "yourself", "u", "ur", "du", "dich", "dir", "dein",
                 "deine", "ihr", "euch", "tu", "te", "toi", "ton", "ta", "tes", "vous",
                 "votre", "vos", "ti", "tus", "usted", "ustedes", "vosotros"]

#: What digits and signs stand for in disguised words.
DISGUISES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s",
             "!": "i", "*": "", ".": "", "-": "", "_": "", " ": ""}

#: Lengths of the word beginnings that may enter the lexicon.
BEGINNINGS = (4, 5, 6)

FEATURES = ["hit_density", "hit_weight", "distinct_hits", "near_you", "you_density",
            "capitals", "shouted_words", "loud_marks", "marks", "disguised", "disguised_hits",
            "log_words"]


@dataclass(frozen=True)
class Settings:
    max_training: int = 15_000  # labelled rows learned from, at most
    folds: int = 3              # of the cross-fitting
    min_support: int = 6        # toxic documents that show a lexicon entry, at least
    min_share: float = 0.002    # and of all toxic ones learned from
    min_precision: float = 0.8  # share of toxic ones among the documents that show it
    reach: int = 3              # words between a hit and a second-person pronoun
    trees: int = 20
    depth: int = 3
    seed: int = 7


PRODUCTION = Settings()


def is_held_out(doc_id: str | Column) -> Column:
    """Rows that must not teach: remainder 0, or no id."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.pmod(F.crc32(c.cast("string").cast("binary")), F.lit(5)) == 0, F.lit(True))


# ------------------------------------------------------------------ lexicon

def term_function():
    """An Arrow function from texts to their distinct words and word beginnings (``*``)."""

    @F.arrow_udf("array<string>")
    def terms(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        word = re.compile(r"[^\W\d_]+")
        for batch in batches:
            rows = []
            for text in batch:
                words = set(word.findall((text.as_py() or "").lower()))
                starts = {w[:k] + "*" for w in words for k in BEGINNINGS if len(w) > k}
                rows.append(sorted(words | starts))
            yield pa.array(rows, pa.list_(pa.string()))

    return terms


def term_counts(sample: DataFrame, s: Settings) -> DataFrame:
    """Per term the toxic (``t``) and clean (``c``) documents that show it, as arrays over
    the folds, from (text, toxic, fold); a written table of the terms with support."""
    terms = sample.select("toxic", "fold", F.explode(term_function()("text")).alias("term"))

    def per_fold(toxic: int) -> Column:
        return F.array(*[F.count_if((F.col("toxic") == toxic) & (F.col("fold") == k))
                         for k in range(s.folds)])

    found = terms.groupBy("term").agg(per_fold(1).alias("t"), per_fold(0).alias("c"))
    return written(found.where(_but("t", None) >= s.min_support), "toxic-terms")


def _but(counts: str, left_out: int | None) -> Column:
    return F.aggregate(counts, F.lit(0).cast("long"), lambda a, x: a + x) - (
        F.lit(0) if left_out is None else F.col(counts)[left_out])


def learn_lexicon(counts: DataFrame, n: dict[int, int], weight: dict[int, float], s: Settings,
                  left_out: int | None = None) -> dict[str, float]:
    """Entries with their log odds from :func:`term_counts` without the fold ``left_out``;
    ``n`` rows of each label are in the other folds.  All that have the support enter; the
    rows learned from, and the share of them that must show an entry, bound their number."""
    found = counts.select("term", _but("t", left_out).alias("t"), _but("c", left_out).alias("c"))
    toxic, clean = weight[1] * F.col("t"), weight[0] * F.col("c")
    found = found.where((F.col("t") >= max(s.min_support, math.ceil(s.min_share * n[1])))
                        & (toxic >= s.min_precision * (toxic + clean)))
    lexicon: dict[str, float] = {}
    for r in sorted(found.collect(), key=lambda r: (len(r["term"].rstrip("*")), r["term"])):
        # a word or a longer beginning of a known beginning adds nothing
        if not any(r["term"][:k] + "*" in lexicon for k in BEGINNINGS
                   if len(r["term"].rstrip("*")) >= k and r["term"] != r["term"][:k] + "*"):
            odds = ((r["t"] + 0.5) / (n[1] + 1)) / ((r["c"] + 0.5) / (n[0] + 1))
            lexicon[r["term"]] = math.log(odds)
    return lexicon


# ------------------------------------------------------------------ features

def feature_function(lexicon: dict[str, float], reach: int):
    """An Arrow function from texts to their features, in the order of ``FEATURES``."""

    @F.arrow_udf("array<double>")
    def features(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        import ahocorasick
        import numpy as np

        search = ahocorasick.Automaton()
        for entry, weight in lexicon.items():
            search.add_word(entry.rstrip("*"), (len(entry.rstrip("*")), entry, weight))
        for pronoun in SECOND_PERSON:
            if pronoun not in search:
                search.add_word(pronoun, (len(pronoun), None, 0.0))
        search.make_automaton()
        shouted = re.compile(r"(?<![A-Z])[A-Z]{3,}(?![a-z])")
        mixed = re.compile(r"[a-z]+[0-9@$!*][0-9a-z@$!*]*[a-z]")
        spaced = re.compile(r"(?<![a-z])(?:[a-z][ .\-_*]){3,}[a-z](?![a-z])")
        undisguise = str.maketrans(DISGUISES)
        capital = np.zeros(256, bool)
        capital[65:91] = True
        mark = np.zeros(256, bool)
        mark[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True

        def in_lexicon(word: str) -> bool:
            return word in lexicon or any(word[:k] + "*" in lexicon for k in BEGINNINGS)

        def measure(text: str) -> list[float]:
            if not text:
                return [0.0] * len(FEATURES)
            low = text.lower()
            n_words = len(low.split()) or 1
            hits, you = [], []
            weight, distinct = 0.0, set()
            for end, (length, entry, value) in search.iter(low):
                start = end - length + 1
                if start and low[start - 1].isalpha():
                    continue
                goes_on = end + 1 < len(low) and low[end + 1].isalpha()
                if goes_on and (entry is None or entry[-1] != "*"):
                    continue
                if entry is None:
                    you.append(start)
                else:
                    hits.append(start)
                    weight += value
                    distinct.add(entry)
            near = 0
            if hits and you:
                at = np.array(you)
                for h in hits:
                    k = int(np.searchsorted(at, h))
                    for y in at[max(0, k - 1):k + 1].tolist():
                        if low.count(" ", min(h, y), max(h, y)) <= reach:
                            near += 1
                            break
            bytes_ = np.bincount(np.frombuffer(text.encode(), np.uint8), minlength=256)
            odd = mixed.findall(low) + spaced.findall(low)
            return [len(hits) / n_words, weight / n_words, float(len(distinct)),
                    near / n_words, len(you) / n_words,
                    bytes_[capital].sum() / len(text), len(shouted.findall(text)) / n_words,
                    (bytes_[33] + bytes_[63]) / n_words, bytes_[mark].sum() / len(text),
                    len(odd) / n_words,
                    float(sum(in_lexicon(w.translate(undisguise)) for w in odd)),
                    math.log(n_words)]

        for batch in batches:
            yield pa.array([measure(text.as_py()) for text in batch], pa.list_(pa.float64()))

    return features


# ------------------------------------------------------------------ model

@dataclass
class ToxicityModel:
    """A fitted model; without trees it scores everything 0."""

    lexicon: dict[str, float]
    trees: object = None
    calibration: object = None
    reach: int = 3

    def score(self, docs: DataFrame, text: str = "text") -> DataFrame:
        """``docs`` plus ``score`` and ``predicted``."""
        bounded_batches(docs.sparkSession)
        names = carried(docs, ["score", "predicted"])
        if self.trees is None:
            return docs.select(*[F.col(f"`{c}`") for c in names], F.lit(0.0).alias("score"),
                               F.lit(0).alias("predicted"))
        rows = docs.select(packed(names), _features(text, self.lexicon, self.reach))
        out = self.calibration.transform(_raw(self.trees, rows))
        score = F.least(F.greatest(F.col("score"), F.lit(0.0)), F.lit(1.0))
        return out.select(*unpacked(names), score.alias("score"),
                          F.when(score >= 0.5, 1).otherwise(0).alias("predicted"))


def _features(text: str, lexicon: dict[str, float], reach: int) -> Column:
    return array_to_vector(feature_function(lexicon, reach)(text_of(text))).alias("features")


def _raw(trees, rows: DataFrame) -> DataFrame:
    return trees.transform(rows).withColumn("margin", vector_to_array("probability")[1]).drop(
        "rawPrediction", "probability", "prediction")


def training_sample(docs: DataFrame, labels: DataFrame, s: Settings, doc_id: str = "doc_id",
                    text: str = "text") -> DataFrame:
    """(text, toxic, weight, fold): at most ``max_training`` labelled rows, as a written
    table.  Of the rarer label all rows stay, up to half of ``max_training``."""
    marked = written(labels.where(F.col("toxic").isNotNull() & ~is_held_out(doc_id)).groupBy(
        F.col(doc_id).alias("_id")).agg(F.max(F.col("toxic").cast("int")).alias("toxic")),
        "toxic-labels")
    n = {r["toxic"]: r["count"] for r in marked.groupBy("toxic").count().collect()}
    ids = []  # bounded by max_training rows of three short columns
    for t in (0, 1):
        most = max(s.max_training // 2, s.max_training - n.get(1 - t, 0))
        drawn = marked.where(F.col("toxic") == t).orderBy(
            F.xxhash64(F.lit("toxic"), "_id"), "_id").limit(most).collect()
        ids += [(r["_id"], t, n[t] / len(drawn), i % s.folds) for i, r in enumerate(drawn)]
    chosen = docs.sparkSession.createDataFrame(ids, StructType([
        marked.schema["_id"], *[StructField(c, k) for c, k in (
            ("toxic", IntegerType()), ("weight", DoubleType()), ("fold", IntegerType()))]]))
    rows = docs.select(F.col(doc_id).alias("_id"), text_of(text).alias("text"))
    return written(rows.join(F.broadcast(chosen), "_id").select("text", "toxic", "weight", "fold"),
                   "toxic-sample")


def fit(docs: DataFrame, labels: DataFrame, s: Settings = PRODUCTION, doc_id: str = "doc_id",
        text: str = "text") -> ToxicityModel:
    bounded_batches(docs.sparkSession)
    sample = training_sample(docs, labels, s, doc_id, text)
    seen = sample.groupBy("toxic", "fold").agg(F.count(F.lit(1)).alias("n"),
                                               F.max("weight").alias("w")).collect()
    folds = range(s.folds)

    def rows_of(left_out: int | None) -> dict[int, int]:
        return {t: sum(r["n"] for r in seen if r["toxic"] == t and r["fold"] != left_out)
                for t in (0, 1)}

    if min(min(rows_of(k).values()) for k in folds) == 0:
        warnings.warn(f"toxicity: no model from {rows_of(None)} labelled rows", stacklevel=2)
        return ToxicityModel({})
    counts = term_counts(sample, s)
    weight = {t: max(r["w"] for r in seen if r["toxic"] == t) for t in (0, 1)}
    # each fold measured with the lexicon of the others
    parts = [sample.where(F.col("fold") == k).select(feature_function(
        learn_lexicon(counts, rows_of(k), weight, s, k), s.reach)("text").alias("f"),
        "toxic", "weight", "fold") for k in folds]
    rows = written(reduce(DataFrame.unionAll, parts), "toxic-features")
    rows = rows.select(array_to_vector("f").alias("features"),
                       F.col("toxic").cast("double").alias("label"), "weight", "fold")
    grow = GBTClassifier(maxIter=s.trees, maxDepth=s.depth, seed=s.seed, weightCol="weight")

    def trees_without(left_out: int | None):
        return grow.fit((rows if left_out is None else rows.where(
            F.col("fold") != left_out)).coalesce(4))

    judged = reduce(DataFrame.unionAll, [
        _raw(trees_without(k), rows.where(F.col("fold") == k)) for k in folds])
    calibration = IsotonicRegression(featuresCol="margin", predictionCol="score",
                                     weightCol="weight").fit(judged.coalesce(1))
    lexicon = learn_lexicon(counts, rows_of(None), weight, s)
    return ToxicityModel(lexicon, trees_without(None), calibration, s.reach)


def op6_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(docs, table(spark, sf_dir, "labels"))
    return model.score(docs).select("doc_id", is_held_out("doc_id").alias("held_out"),
                                    "score", "predicted")
