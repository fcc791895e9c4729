"""Supervised models (F1-F4, G1-G11) on Spark ML.

Labels of any value set (1..7, {1, 2}, strings) are indexed to 0..n-1 before the fit, and
every classifier is one ``PipelineModel``

    VectorAssembler -> [VectorIndexer] -> estimator -> IndexToString -> LabelRestorer

whose predictions come back in the original label space -- Spark's Naive Bayes would
otherwise silently predict indices.  The last stage knows the label, its type, the features
and their order, so a saved model needs no explanation.  The label indexer is no stage of
it: scoring needs no label, and rows whose label the training set lacks are scored like any
other.  Categories that the training set lacks fall into an extra bucket of their feature.  Training and
scoring run in the JVM; only fitted parameters (classes x features) reach the driver.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark import StorageLevel, keyword_only
from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LinearSVC,
    LogisticRegression,
    MultilayerPerceptronClassifier,
    NaiveBayes,
    RandomForestClassifier,
)
from pyspark.ml.feature import (
    IndexToString,
    StringIndexerModel,
    VectorAssembler,
    VectorIndexer,
    VectorIndexerModel,
)
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

LABEL_IDX = "label_idx"
FEATURES = "features"
PREDICTED = "predicted_label"

# ------------------------------------------------------------------ estimator presets
# Parameter values of the original cells (fixed values).


def naive_bayes(smoothing: float = 1.0) -> NaiveBayes:
    """G1: multinomial Naive Bayes, additive smoothing 1.0."""
    return NaiveBayes(smoothing=smoothing, modelType="multinomial")


def decision_tree(impurity: str = "entropy", max_depth: int = 10, max_bins: int = 32,
                  seed: int = 0) -> DecisionTreeClassifier:
    """Entropy, depth 10, 32 bins."""
    return DecisionTreeClassifier(impurity=impurity, maxDepth=max_depth, maxBins=max_bins,
                                  seed=seed)


def gradient_boosted_trees(max_iter: int = 10, seed: int = 0) -> GBTClassifier:
    """Binary GBT, 10 iterations (labels must index to {0, 1})."""
    return GBTClassifier(maxIter=max_iter, seed=seed)


def random_forest(num_trees: int = 20, seed: int = 0, **params) -> RandomForestClassifier:
    """Random forest with Spark's defaults."""
    return RandomForestClassifier(numTrees=num_trees, seed=seed, **params)


def perceptron(layers: Sequence[int], max_iter: int = 100, block_size: int = 128,
               seed: int = 1234) -> MultilayerPerceptronClassifier:
    """Multilayer perceptron (the original used layers 4-5-4-3)."""
    return MultilayerPerceptronClassifier(layers=list(layers), maxIter=max_iter,
                                          blockSize=block_size, seed=seed)


def logistic_elastic_net(max_iter: int = 10, reg_param: float = 0.3,
                         elastic_net: float = 0.8) -> LogisticRegression:
    """Elastic-net logistic regression."""
    return LogisticRegression(maxIter=max_iter, regParam=reg_param,
                              elasticNetParam=elastic_net)


def logistic_lbfgs(fit_intercept: bool = False, reg_param: float = 0.0,
                   max_iter: int = 100) -> LogisticRegression:
    """L-BFGS logistic regression with the RDD API's defaults (no intercept, no
    penalty)."""
    return LogisticRegression(fitIntercept=fit_intercept, regParam=reg_param,
                              maxIter=max_iter)


def linear_svm(max_iter: int = 100, reg_param: float = 0.01,
               fit_intercept: bool = False) -> LinearSVC:
    """Linear SVM with the RDD API's defaults."""
    return LinearSVC(maxIter=max_iter, regParam=reg_param, fitIntercept=fit_intercept)


# ------------------------------------------------------------------ label handling

# The orders of Spark's StringIndexer, ties by name.
LABEL_ORDERS = {
    "frequencyDesc": lambda name, n: (-n, name),
    "frequencyAsc": lambda name, n: (n, name),
    "alphabetAsc": lambda name, n: name,
}


def index_labels(df: DataFrame, label: str, order: str = "alphabetAsc",
                 output: str = LABEL_IDX) -> StringIndexerModel:
    """the label indexer, from one aggregate of label counts; one row per distinct
    label reaches the driver.  NULL labels are not counted.

    Unseen labels raise at transform time (``keep`` would add a phantom class to the
    label metadata and turn binary models multinomial): fit it on the whole set when a
    test split may hold labels the training split lacks."""
    if order not in (*LABEL_ORDERS, "alphabetDesc"):
        raise ValueError(f"unknown label order {order!r}")
    counts = df.where(F.col(label).isNotNull()).groupBy(
        F.col(label).cast("string").alias("name")).agg(F.count(F.lit(1)).alias("n")).collect()
    if order == "alphabetDesc":
        labels = sorted((r["name"] for r in counts), reverse=True)
    else:
        labels = [r["name"] for r in sorted(
            counts, key=lambda r: LABEL_ORDERS[order](r["name"], r["n"]))]
    return StringIndexerModel.from_labels(labels, inputCol=label, outputCol=output,
                                          handleInvalid="error")


def index_features(df: DataFrame, feature_cols: Sequence[str], max_categories: int = 4,
                   output: str = "indexed_features", unseen: str = "keep"):
    """``VectorIndexer`` over assembled features; a feature with at most
    ``max_categories`` distinct values becomes categorical.  A value that is in no map gets
    the index after the last one (``unseen="keep"``), or raises (``"error"``)."""
    assembled = VectorAssembler(inputCols=list(feature_cols), outputCol=FEATURES).transform(df)
    model = VectorIndexer(inputCol=FEATURES, outputCol=output, maxCategories=max_categories,
                          handleInvalid=unseen).fit(assembled)
    return model, assembled


def category_maps(model) -> list[tuple[int, float, int]]:
    """Rows ``(feature index, value, category index)`` of a fitted ``VectorIndexerModel``."""
    return [(int(f), float(v), int(i))
            for f, mapping in sorted(model.categoryMaps.items())
            for v, i in sorted(mapping.items())]


def unseen_categories(df: DataFrame, model, feature_cols: Sequence[str]) -> DataFrame:
    """``(feature, n, n_unseen)`` for every categorical feature of a fitted
    ``VectorIndexerModel``: how many rows hold a value that its map lacks.  One aggregate;
    NULL is no value.  The maps hold at most ``max_categories`` values each."""
    maps = {feature_cols[int(f)]: [float(v) for v in m] for f, m in model.categoryMaps.items()}
    names = [c for c in feature_cols if c in maps]
    spark = df.sparkSession
    if not names:
        return spark.createDataFrame([], "feature string, n long, n_unseen long")
    counts = df.agg(*[F.count(F.col(c)).alias(f"n_{i}") for i, c in enumerate(names)], *[
        F.count_if(~F.col(c).cast("double").isin(maps[c])).alias(f"u_{i}")
        for i, c in enumerate(names)])
    rows = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"n_{i}").alias("n"),
                              F.col(f"u_{i}").alias("n_unseen")) for i, c in enumerate(names)])
    return counts.select(F.inline(rows))


#: What :class:`LabelRestorer` writes; a reader refuses a higher number.
MODEL_VERSION = 1


class LabelRestorer(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Last stage of a pipeline: ``prediction`` in the type of the label (the index goes to
    ``prediction_idx``), and what is needed to use the pipeline elsewhere: the label's name
    and type, the features in their order, the version of this record."""

    label = Param(Params._dummy(), "label", "name of the label", TypeConverters.toString)
    labelType = Param(Params._dummy(), "labelType", "type of the label", TypeConverters.toString)
    features = Param(Params._dummy(), "features", "features in order",
                     TypeConverters.toListString)
    version = Param(Params._dummy(), "version", "version of this record", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, label=None, labelType=None, features=None, version=None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _transform(self, df: DataFrame) -> DataFrame:
        kind = T.StructType.fromDDL(f"x {self.getOrDefault('labelType')}")["x"].dataType
        return (df.withColumnRenamed("prediction", "prediction_idx")
                  .withColumn("prediction", F.col(PREDICTED).cast(kind)).drop(PREDICTED))


@dataclass
class Classifier:
    """A fitted classification pipeline, which names what it reads."""

    model: PipelineModel

    def _stage(self, kind: type):
        return next((s for s in self.model.stages if isinstance(s, kind)), None)

    @property
    def card(self) -> LabelRestorer:
        return self.model.stages[-1]

    @property
    def label(self) -> str:
        return self.card.getOrDefault("label")

    @property
    def features(self) -> list[str]:
        return list(self.card.getOrDefault("features"))

    @property
    def label_type(self) -> T.DataType:
        return T.StructType.fromDDL(f"x {self.card.getOrDefault('labelType')}")["x"].dataType

    @property
    def labels(self) -> list[str]:
        return list(self._stage(IndexToString).getLabels())

    @property
    def estimator_model(self):
        return self.model.stages[-3]

    @property
    def categories(self):
        """The fitted ``VectorIndexerModel`` where the pipeline has one."""
        return self._stage(VectorIndexerModel)

    def transform(self, df: DataFrame) -> DataFrame:
        """Adds ``prediction`` in the original label space (and ``prediction_idx``)."""
        return self.model.transform(df)

    def unseen(self, df: DataFrame) -> DataFrame:
        """``(feature, n, n_unseen)``: rows with categories the training set lacks."""
        if self.categories is None:
            return df.sparkSession.createDataFrame([], "feature string, n long, n_unseen long")
        return unseen_categories(df, self.categories, self.features)

    def save(self, path: str) -> None:
        """A16 sink: the whole pipeline (assembler, category maps, model, label map, card)."""
        self.model.write().overwrite().save(path)

    @classmethod
    def load(cls, path: str) -> Classifier:
        """A16 source: the path alone.  Raises for pipelines that were not saved by
        :meth:`save` and for those of a later version."""
        model = PipelineModel.load(path)
        card = model.stages[-1] if model.stages else None
        if not isinstance(card, LabelRestorer):
            raise ValueError(f"{path} holds no classifier with a description")
        if card.getOrDefault("version") > MODEL_VERSION:
            raise ValueError(f"{path} has version {card.getOrDefault('version')}, "
                             f"this library reads up to {MODEL_VERSION}")
        return cls(model)


def fit_classifier(train: DataFrame, estimator, label: str, features: Sequence[str],
                   label_source: DataFrame | None = None,
                   max_categories: int | None = None,
                   label_order: str = "alphabetAsc",
                   invalid_features: str = "error",
                   unseen: str = "keep",
                   storage_level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> Classifier:
    """fit ``assembler -> [vector indexer] -> estimator -> label map``.

    ``label_source`` fits the label indexer -- and the vector indexer when
    ``max_categories`` is set -- on another frame: the original fitted both on the whole
    set, before the split, so every label and category is known.  ``label_order`` is
    ``StringIndexer``'s order (``frequencyDesc`` is its default).  A NULL or NaN feature
    raises by default (``invalid_features="error"``): ``"skip"`` would silently drop
    rows, also when scoring, so it has to be asked for.

    With ``max_categories`` a value that the maps lack falls into the extra bucket of its
    feature (``unseen="keep"``; :meth:`Classifier.unseen` counts them) or fails the scoring
    (``"error"``); trees need ``maxBins`` of at least ``max_categories + 1`` for it.

    Label and features alone are read, and persisted (``storage_level``; ``DISK_ONLY``
    suits training sets far larger than executor memory) around an iterative fit; a fit
    of one pass (Naive Bayes) reads its input as it is."""
    label_type = train.schema[label].dataType
    needed = list(dict.fromkeys([label, *features]))
    rows = train.select(*needed)
    source = label_source.select(*needed) if label_source is not None else rows
    iterative = not isinstance(estimator, NaiveBayes)
    if iterative:
        rows = rows.persist(storage_level)
        source = rows if label_source is None else source
    try:
        indexer = index_labels(source, label, order=label_order)
        assembler = VectorAssembler(inputCols=list(features), outputCol=FEATURES,
                                    handleInvalid=invalid_features)
        stages, feat_col = [assembler], FEATURES
        if max_categories is not None:
            feat_col = "indexed_features"
            stages.append(VectorIndexer(inputCol=FEATURES, outputCol=feat_col,
                                        maxCategories=max_categories, handleInvalid=unseen)
                          .fit(assembler.transform(source)))
        plain = isinstance(label_type, (T.NumericType, T.StringType))
        ready = indexer.transform(rows if plain else rows.withColumn(
            label, F.col(label).cast("string")))
        for stage in stages:
            ready = stage.transform(ready)
        fitted = estimator.copy().setLabelCol(LABEL_IDX).setFeaturesCol(feat_col).fit(
            ready.select(LABEL_IDX, feat_col))
        names = IndexToString(inputCol="prediction", outputCol=PREDICTED, labels=indexer.labels)
        card = LabelRestorer(label=label, labelType=label_type.simpleString(),
                             features=list(features), version=MODEL_VERSION)
        return Classifier(PipelineModel([*stages, fitted, names, card]))
    finally:
        if iterative:
            rows.unpersist()


# ------------------------------------------------------------------ fitted parameters

def naive_bayes_parameters(clf: Classifier) -> list[tuple[str, int, float, float]]:
    """G1: ``(label, feature index, log prior, log likelihood)`` rows (k x d values)."""
    nb = clf.estimator_model
    pi = nb.pi.toArray()
    theta = nb.theta.toArray()
    return [(lab, j, float(pi[c]), float(theta[c, j]))
            for c, lab in enumerate(clf.labels) for j in range(theta.shape[1])]


def linear_coefficients(clf: Classifier) -> list[tuple[int, float, float]]:
    """``(feature index, coefficient, intercept)`` of a binary linear model."""
    m = clf.estimator_model
    coefs = m.coefficients.toArray()
    return [(j, float(c), float(m.intercept)) for j, c in enumerate(coefs)]


def tree_debug_string(clf: Classifier) -> str:
    """The tree (or ensemble) as text."""
    return clf.estimator_model.toDebugString
