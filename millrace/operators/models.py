"""Classifiers: logistic regression, random forest and depth-limited boosting on MLlib, leaf-limited boosting.

A fitted model takes the columns it was fitted on and adds ``prediction`` (class name) and
``probability`` (one double per class, classes sorted). MLlib's learners refuse missing values, so
gaps are filled for them (median plus an indicator column); leaf-limited boosting learns from gaps.
"""

from __future__ import annotations

import logging
from typing import Any

from pyspark.ml import Estimator
from pyspark.ml.classification import (
    GBTClassificationModel,
    GBTClassifier,
    LogisticRegression,
    LogisticRegressionModel,
    OneVsRest,
    OneVsRestModel,
    RandomForestClassificationModel,
    RandomForestClassifier,
)
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.columns import as_double, class_counts, class_index, col
from millrace.functions.quantiles import exact_quantiles
from millrace.operators.base import Configured, Fitted, Persisted, number, one_of, optional, param, text
from millrace.operators.leafwise import LeafwiseModel, fit_leafwise
from millrace.sources.scratch import scratch_scope, write_table

log = logging.getLogger(__name__)

FEATURES, TARGET, WEIGHT, DRAW = "__features", "__target", "__weight", "__draw"
MISSING_SUFFIX = "_missing"
MAX_DEPTH = 30
MAX_BINS = 128
XGB_RATE = 0.3


class Classifier(Configured, Estimator, Persisted):
    """Shared fit: resolve columns and classes, assemble, let the learner fit."""

    def _learner(self, classes: list[tuple[Any, int]], rows: int):
        raise NotImplementedError

    def _balanced(self) -> bool:
        return False

    def _carried(self, df: DataFrame) -> list[Column]:
        """Columns beside features and label that the learner reads."""
        return []

    def _fit(self, df: DataFrame) -> ClassifierModel:
        label = self.label(df)
        columns, unusable = [], []
        for f in df.schema.fields:
            if f.name in self.reserved:
                continue
            usable = isinstance(f.dataType, (T.NumericType, T.BooleanType))
            (columns if usable else unusable).append(f.name)
        if unusable:
            raise ValueError(f"encode or drop these columns before the model: {unusable}")
        if not columns:
            raise ValueError("no feature column left for the model")
        # read by several passes of the learner: prepared once, with the used columns only
        used = [*[col(c) for c in [*columns, label]], *self._carried(df)]
        with scratch_scope(df.sparkSession):
            df, _ = write_table(df.filter(col(label).isNotNull()).select(*used))
            counts = class_counts(df, label)
            if len(counts) < 2:
                raise ValueError(f"'{label}' needs at least two classes, found {[c for c, _ in counts]}")
            return self._fitted(df, columns, label, counts)

    def _fitted(self, df: DataFrame, columns: list[str], label: str, counts: list[tuple[Any, int]]) -> ClassifierModel:
        """The model of one of MLlib's learners."""
        classes, rows = [c for c, _ in counts], sum(n for _, n in counts)
        model = self._model(columns, self._fills(df, columns), classes)
        prepared = model.assembled(df).withColumn(TARGET, class_index(col(label), classes))
        used = [FEATURES, TARGET]
        if self._balanced():
            weights = {float(i): rows / (len(classes) * n) for i, (_, n) in enumerate(counts)}
            pairs = [F.lit(x) for kv in weights.items() for x in kv]
            prepared = prepared.withColumn(WEIGHT, F.element_at(F.create_map(*pairs), F.col(TARGET)))
            used.append(WEIGHT)
        model.inner = self._learner(counts, rows).fit(prepared.select(*used))
        return model

    def _model(self, columns: list[str], fills: dict[str, float], classes: list[Any]) -> ClassifierModel:
        return ClassifierModel(
            idCol=self.get("idCol"),
            labelCol=self.get("labelCol"),
            state={"columns": columns, "fills": fills, "classes": classes},
        )

    def _fills(self, df: DataFrame, columns: list[str]) -> dict[str, float]:
        """Exact medians of the columns that have gaps, the same on every cluster."""
        gaps = df.agg(
            *[F.count_if(as_double(c).isNull()).alias(f"g{i}") for i, c in enumerate(columns)]
        ).first()
        gappy = [c for i, c in enumerate(columns) if gaps[f"g{i}"]]
        found = exact_quantiles(df, gappy, [0.5])
        return {c: found[c][0] or 0.0 for c in gappy}


class ClassifierModel(Fitted, MLWritable, MLReadable):
    """A fitted learner with the columns, fills and classes it was fitted with."""

    inner: Any = None

    @property
    def classes(self) -> list[Any]:
        return self.learned["classes"]

    @property
    def features(self) -> list[str]:
        return self.learned["columns"] + [c + MISSING_SUFFIX for c in self.learned["fills"]]

    def source_column(self, feature: str) -> str:
        """The input column a feature comes from."""
        return feature if feature in self.learned["columns"] else feature.removesuffix(MISSING_SUFFIX)

    def assembled(self, df: DataFrame) -> DataFrame:
        fills = self.learned["fills"]
        inputs: dict[str, Column] = {}
        for c in self.learned["columns"]:
            inputs[c] = F.coalesce(as_double(c), F.lit(fills.get(c, 0.0)))
        for c in fills:
            inputs[c + MISSING_SUFFIX] = as_double(c).isNull().cast("double")
        named = {f"__f{i}": inputs[f] for i, f in enumerate(self.features)}
        assembler = VectorAssembler(inputCols=list(named), outputCol=FEATURES)
        return assembler.transform(df.withColumns(named)).drop(*named)

    def _transform(self, df: DataFrame) -> DataFrame:
        if isinstance(self.inner, LeafwiseModel):
            return self._named(df.withColumn("probability", self.inner.probability([as_double(c) for c in self.learned["columns"]])))
        ready = self.assembled(df)
        if isinstance(self.inner, OneVsRestModel):
            # one probability per class against the rest, scaled to sum to one
            for i, sub in enumerate(self.inner.models):
                one = sub.copy()
                one.setFeaturesCol(FEATURES).setPredictionCol("").setRawPredictionCol("").setProbabilityCol(f"__p{i}")
                ready = one.transform(ready)
            ready = ready.withColumns(
                {f"__p{i}": vector_to_array(f"__p{i}")[1] for i in range(len(self.inner.models))}
            )
            parts = [F.col(f"__p{i}") for i in range(len(self.inner.models))]
            total = sum(parts[1:], parts[0])
            scored = ready.withColumn("probability", F.array(*[p / total for p in parts]))
            scored = scored.drop(*[f"__p{i}" for i in range(len(parts))])
        else:
            inner = self.inner.copy()
            inner.setFeaturesCol(FEATURES).setPredictionCol("").setRawPredictionCol("__raw").setProbabilityCol("__p")
            scored = inner.transform(ready).withColumn("probability", vector_to_array("__p")).drop("__raw", "__p")
        return self._named(scored.drop(FEATURES))

    def _named(self, scored: DataFrame) -> DataFrame:
        """With the name of the first of the likeliest classes."""
        best = F.array_position(F.col("probability"), F.array_max("probability")).cast("int")
        names = F.array(*[F.lit(c) for c in self.classes])
        return scored.withColumn("prediction", F.element_at(names, best))

    def importances(self) -> dict[str, float]:
        """Non-negative importance per feature (mean over the sub-models of one-vs-rest)."""
        if isinstance(self.inner, LogisticRegressionModel):
            values = abs(self.inner.coefficientMatrix.toArray()).mean(axis=0)
        elif isinstance(self.inner, OneVsRestModel):
            values = sum(m.featureImportances.toArray() for m in self.inner.models) / len(self.inner.models)
        elif isinstance(self.inner, LeafwiseModel):
            values = self.inner.importances()
        else:
            values = self.inner.featureImportances.toArray()
        return dict(zip(self.features, (float(v) for v in values)))

    def write(self) -> MLWriter:
        return ClassifierWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return ClassifierReader()


INNER_MODELS = {
    m.__name__: m
    for m in (GBTClassificationModel, LeafwiseModel, LogisticRegressionModel, OneVsRestModel, RandomForestClassificationModel)
}


class ClassifierWriter(MLWriter):
    def __init__(self, instance: ClassifierModel) -> None:
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        inner = self.instance.inner
        DefaultParamsWriter.saveMetadata(
            self.instance, path, self.sparkSession, extraMetadata={"inner": type(inner).__name__}
        )
        inner.save(f"{path}/inner")


class ClassifierReader(MLReader):
    def load(self, path: str) -> ClassifierModel:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = ClassifierModel()
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        model.inner = INNER_MODELS[metadata["inner"]].load(f"{path}/inner")
        return model


class LogisticClassifier(Classifier):
    """L2-regularised logistic regression; ``C`` is the inverse regularisation strength."""

    C = param("C", "inverse regularisation strength", number(0, open_low=True))
    max_iter = param("max_iter", "iterations at most", number(1, whole=True))
    random_state = param("random_state", "accepted for older specs; the solver draws nothing", number(whole=True))
    DEFAULTS = {"C": 1.0, "max_iter": 1000, "random_state": 42}

    def _learner(self, classes, rows):
        # C * sum(loss) + |w|^2 / 2 has the same minimum as mean(loss) + |w|^2 / (2 C n)
        return LogisticRegression(
            featuresCol=FEATURES,
            labelCol=TARGET,
            family="binomial" if len(classes) == 2 else "multinomial",
            regParam=1.0 / (self.get("C") * rows),
            elasticNetParam=0.0,
            standardization=False,
            maxIter=self.get("max_iter"),
            aggregationDepth=2 if rows < 10_000_000 else 3,
        )


class RandomForest(Classifier):
    """Random forest; classes weighted inversely to their size by default."""

    n_estimators = param("n_estimators", "number of trees", number(1, whole=True))
    max_depth = param("max_depth", "tree depth; null = as deep as MLlib grows", optional(number(1, whole=True)))
    min_samples_leaf = param("min_samples_leaf", "rows per leaf at least", number(1, whole=True))
    max_bins = param("max_bins", "ranges a column is cut into for splits", number(2, whole=True))
    class_weight = param("class_weight", "balanced or null", optional(one_of("balanced")))
    random_state = param("random_state", "seed", number(whole=True))
    n_jobs = param("n_jobs", "accepted for older specs; Spark sets the parallelism", number(whole=True))
    DEFAULTS = {
        "n_estimators": 300,
        "max_depth": None,
        "min_samples_leaf": 2,
        "max_bins": MAX_BINS,
        "class_weight": "balanced",
        "random_state": 42,
        "n_jobs": -1,
    }

    def _balanced(self) -> bool:
        return self.get("class_weight") == "balanced"

    def _learner(self, classes, rows):
        forest = RandomForestClassifier(
            featuresCol=FEATURES,
            labelCol=TARGET,
            numTrees=self.get("n_estimators"),
            maxDepth=tree_depth(self.get("max_depth")),
            maxBins=self.get("max_bins"),
            minInstancesPerNode=self.get("min_samples_leaf"),
            featureSubsetStrategy="auto",
            seed=self.get("random_state"),
            maxMemoryInMB=512,
        )
        return forest.setWeightCol(WEIGHT) if self._balanced() else forest


def tree_depth(wanted: int | None) -> int:
    """The depth asked for; without one as deep as MLlib grows, which the log says."""
    if wanted is None:
        log.info("trees grow to a depth of %d at most", MAX_DEPTH)
        return MAX_DEPTH
    if wanted > MAX_DEPTH:
        raise ValueError(f"max_depth must be at most {MAX_DEPTH} or null, not {wanted}")
    return wanted


def boosted(stage: Classifier, n_classes: int, depth: int):
    """Gradient-boosted trees; more than two classes are fitted one against the rest."""
    gbt = GBTClassifier(
        featuresCol=FEATURES,
        labelCol=TARGET,
        maxIter=stage.get("n_estimators"),
        maxDepth=tree_depth(depth),
        maxBins=stage.get("max_bins"),
        stepSize=stage.get("learning_rate"),
        subsamplingRate=stage.get("subsample"),
        featureSubsetStrategy=str(stage.get("colsample_bytree")) if stage.get("colsample_bytree") < 1 else "all",
        seed=stage.get("random_state"),
        checkpointInterval=10,
        maxMemoryInMB=512,
    )
    if n_classes == 2:
        return gbt
    return OneVsRest(featuresCol=FEATURES, labelCol=TARGET, classifier=gbt, parallelism=min(n_classes, 4))


class BoostedTrees(Classifier):
    """Boosted trees, depth-limited preset."""

    n_estimators = param("n_estimators", "boosting rounds", number(1, whole=True))
    max_depth = param("max_depth", "tree depth", number(1, whole=True))
    learning_rate = param("learning_rate", "shrinkage, 0.5 at most", number(0, 0.5, open_low=True))
    subsample = param("subsample", "share of rows per round", number(0, 1, open_low=True))
    colsample_bytree = param("colsample_bytree", "share of columns tried per node", number(0, 1, open_low=True))
    max_bins = param("max_bins", "ranges a column is cut into for splits", number(2, whole=True))
    eval_metric = param("eval_metric", "accepted for older specs; MLlib fixes its loss", text)
    random_state = param("random_state", "seed", number(whole=True))
    n_jobs = param("n_jobs", "accepted for older specs; Spark sets the parallelism", number(whole=True))
    DEFAULTS = {
        "n_estimators": 500,
        "max_depth": 6,
        "learning_rate": 0.05,
        "subsample": 0.8,
        "colsample_bytree": 0.8,
        "max_bins": MAX_BINS,
        "eval_metric": "mlogloss",
        "random_state": 42,
        "n_jobs": -1,
    }

    def _learner(self, classes, rows):
        return boosted(self, len(classes), self.get("max_depth"))


class LeafLimitedTrees(Classifier):
    """Boosted trees, leaf-limited preset: the leaf that gains most is split next, gaps choose their side.

    All classes share one softmax (two classes one logistic score). A row's part in ``subsample``
    hangs on its id, or without an id column on all its values.
    """

    n_estimators = param("n_estimators", "boosting rounds", number(1, whole=True))
    max_depth = param("max_depth", "tree depth; -1 = any", number(-1, whole=True))
    learning_rate = param("learning_rate", "shrinkage", number(0, 1, open_low=True))
    num_leaves = param("num_leaves", "leaves per tree", number(2, whole=True))
    subsample = param("subsample", "share of rows per round", number(0, 1, open_low=True))
    colsample_bytree = param("colsample_bytree", "share of columns per tree", number(0, 1, open_low=True))
    min_child_samples = param("min_child_samples", "rows per leaf at least", number(1, whole=True))
    reg_lambda = param("reg_lambda", "L2 weight of the leaves' values", number(0))
    max_bins = param("max_bins", "ranges a column is cut into for splits", number(2, 65_000, whole=True))
    class_weight = param("class_weight", "balanced or null", optional(one_of("balanced")))
    random_state = param("random_state", "seed", number(whole=True))
    n_jobs = param("n_jobs", "accepted for older specs; Spark sets the parallelism", number(whole=True))
    verbosity = param("verbosity", "accepted for older specs", number(whole=True))
    DEFAULTS = {
        "n_estimators": 500,
        "max_depth": -1,
        "learning_rate": 0.05,
        "num_leaves": 63,
        "subsample": 0.8,
        "colsample_bytree": 0.8,
        "min_child_samples": 20,
        "reg_lambda": 0.0,
        "max_bins": MAX_BINS,
        "class_weight": "balanced",
        "random_state": 42,
        "n_jobs": -1,
        "verbosity": -1,
    }

    def _balanced(self) -> bool:
        return self.get("class_weight") == "balanced"

    def _carried(self, df: DataFrame) -> list[Column]:
        key = self.get("idCol")
        return [F.xxhash64(*[col(c) for c in ([key] if key in df.columns else df.columns)]).alias(DRAW)]

    def _fitted(self, df: DataFrame, columns: list[str], label: str, counts: list[tuple[Any, int]]) -> ClassifierModel:
        classes, sizes = [c for c, _ in counts], [n for _, n in counts]
        model = self._model(columns, {}, classes)
        model.inner = fit_leafwise(
            df,
            columns,
            class_index(col(label), classes),
            sizes,
            [sum(sizes) / (len(sizes) * n) if self._balanced() else 1.0 for n in sizes],
            col(DRAW),
            rounds=self.get("n_estimators"),
            rate=self.get("learning_rate"),
            n_leaves=self.get("num_leaves"),
            max_depth=self.get("max_depth"),
            least_rows=self.get("min_child_samples"),
            l2=self.get("reg_lambda"),
            subsample=self.get("subsample"),
            colsample=self.get("colsample_bytree"),
            max_bins=self.get("max_bins"),
            seed=self.get("random_state"),
        )
        return model
