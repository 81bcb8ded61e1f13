"""Feature selection by variance, correlation, mutual information and tree importance."""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.ml import Estimator
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.columns import as_double, chunks, class_counts, class_index, col
from millrace.functions.correlation import Pair, correlations
from millrace.functions.neighbours import NEIGHBOURS, neighbour_information
from millrace.functions.quantiles import exact_quantiles
from millrace.functions.values import long_form
from millrace.operators.base import Configured, Fitted, Persisted, number, one_of, param
from millrace.sources.scratch import scratch_scope, write_table

VARIANCES_PER_JOB = 200


class DropModel(Fitted, Persisted):
    """Drops the columns found at fit, if present."""

    def _transform(self, df: DataFrame) -> DataFrame:
        return df.drop(*self.learned["drop"])


class KeepModel(Fitted, Persisted):
    """Keeps the columns found at fit, if present, followed by the other kinds of column."""

    def _transform(self, df: DataFrame) -> DataFrame:
        keys = [c for c in self.reserved if c in df.columns]
        kept = [c for c in self.learned["keep"] + self.learned["others"] if c in df.columns]
        return df.select(*[col(c) for c in dict.fromkeys(keys + kept)])


def variances(df: DataFrame, columns: list[str]) -> dict[str, float | None]:
    """Population variance of every column, nulls left out."""
    out: dict[str, float | None] = {}
    for part in chunks(columns, VARIANCES_PER_JOB):
        row = df.agg(*[F.var_pop(as_double(c)).alias(f"v{i}") for i, c in enumerate(part)]).first()
        out |= {c: row[f"v{i}"] for i, c in enumerate(part)}
    return out


class VarianceThreshold(Configured, Estimator, Persisted):
    """Drop numeric columns whose population variance does not exceed the threshold."""

    threshold = param("threshold", "largest variance that is dropped", number(0))
    DEFAULTS = {"threshold": 0.01}

    def _fit(self, df: DataFrame) -> DropModel:
        found = variances(df, self.numeric(df))
        drop = [c for c, v in found.items() if v is None or v <= self.get("threshold")]
        if found and len(drop) == len(found):
            raise ValueError(f"no numeric column has a variance above {self.get('threshold')}")
        return self.model(DropModel, drop=drop)


def correlated_columns(columns: list[str], found: dict[Pair, float | None], threshold: float) -> list[str]:
    """Of each correlated pair the later column goes, unless its partner went before."""
    kept: list[str] = []
    for c in columns:
        known = [abs(found[k, c]) for k in kept if found[k, c] is not None]
        if not any(r >= threshold for r in known):
            kept.append(c)
    return [c for c in columns if c not in kept]


class CorrelationThreshold(Configured, Estimator, Persisted):
    """Drop the later column of every highly correlated numeric pair."""

    threshold = param("threshold", "absolute correlation that counts as redundant", number(0, 1))
    method = param("method", "spearman or pearson", one_of("pearson", "spearman"))
    DEFAULTS = {"threshold": 0.95, "method": "spearman"}

    def _fit(self, df: DataFrame) -> DropModel:
        columns = self.numeric(df)
        with scratch_scope(df.sparkSession):
            numbers, _ = write_table(df.select(*[col(c) for c in columns]))  # read several times
            found = correlations(numbers, columns, self.get("method"))
        return self.model(DropModel, drop=correlated_columns(columns, found, self.get("threshold")))


MI_BINS = 20


def mutual_information(
    df: DataFrame, columns: list[str], label: str, bins: int = MI_BINS
) -> dict[str, float]:
    """Mutual information (nats) of each binned column with the label.

    A column of at most ``bins`` values has one bin per value, any other is cut at its
    quantiles. Missing values are a bin of their own; unlabelled rows are left out. One
    pass counts (column, bin, label) for all columns, folded within each task.
    """
    labelled = df.filter(col(label).isNotNull())
    classes = [c for c, _ in class_counts(labelled, label)]
    edges = _short_value_lists(labelled, columns, bins)
    long = [c for c in columns if c not in edges]
    cuts = exact_quantiles(labelled, long, [i / bins for i in range(1, bins)])
    edges |= {c: sorted({x for x in cuts[c] if x is not None}) for c in long}
    # the joint table has at most columns x (bins + 1) x classes rows
    scored = (
        _joint_counts(labelled, columns, class_index(col(label), classes), len(classes), edges)
        .withColumn("n_bin", F.sum("n").over(Window.partitionBy("column", "bin")))
        .withColumn("n_label", F.sum("n").over(Window.partitionBy("column", "label")))
        .withColumn("total", F.sum("n").over(Window.partitionBy("column")))
        .groupBy("column")
        .agg(F.sum(F.expr("n / total * ln(n * total / (n_bin * n_label))")).alias("score"))
    )
    scores = {columns[r["column"]]: max(0.0, r["score"]) for r in scored.collect()}
    return {c: scores.get(c, 0.0) for c in columns}


def _joint_counts(
    df: DataFrame, columns: list[str], label: Column, n_classes: int, edges: dict[str, list[float]]
) -> DataFrame:
    """Rows per (column, bin, label); a bin is the number of edges below the value."""
    places = [np.array(edges[c], dtype=float) for c in columns]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = [np.zeros((len(e) + 2) * n_classes, dtype=np.int64) for e in places]
        for batch in batches:
            y = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            for i, e in enumerate(places):
                x = batch.column(i + 1).to_numpy(zero_copy_only=False).astype(float)
                binned = np.where(np.isnan(x), len(e) + 1, np.searchsorted(e, x, side="left"))
                totals[i] += np.bincount(binned * n_classes + y, minlength=len(totals[i]))
        for i, t in enumerate(totals):
            (found,) = np.nonzero(t)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(found), i), pa.int32()),
                    pa.array(found // n_classes, pa.int32()),
                    pa.array(found % n_classes, pa.int32()),
                    pa.array(t[found], pa.int64()),
                ],
                names=["column", "bin", "label", "n"],
            )

    return (
        df.select(label.alias("y"), *[as_double(c).alias(f"x{i}") for i, c in enumerate(columns)])
        .mapInArrow(count, "column int, bin int, label int, n long")
        .groupBy("column", "bin", "label")
        .agg(F.sum("n").alias("n"))
    )


def _short_value_lists(df: DataFrame, columns: list[str], bins: int) -> dict[str, list[float]]:
    """The values of the columns that have ``bins`` at most.

    An estimate rules out the long columns, so only short lists are gathered.
    """
    row = df.agg(*[F.approx_count_distinct(as_double(c)).alias(f"d{i}") for i, c in enumerate(columns)]).first()
    maybe = [c for i, c in enumerate(columns) if row[f"d{i}"] <= 2 * bins]
    if not maybe:
        return {}
    listed = (
        long_form(df, {c: as_double(c) for c in maybe})
        .filter(F.col("value").isNotNull())
        .distinct()
        .groupBy("column")
        .agg(F.sort_array(F.collect_list("value")).alias("values"))
    )
    found = {r["column"]: r["values"] for r in listed.collect()}
    return {c: found.get(c, []) for c in maybe if len(found.get(c, [])) <= bins}


class MutualInformation(Configured, Estimator, Persisted):
    """Keep the k numeric columns that tell most about the label, best first.

    The estimate is made from quantile bins, in one pass over the rows, or from nearest neighbours
    among the values as they are, which sorts every column.
    """

    k = param("k", "number of columns to keep", number(1, whole=True))
    random_state = param("random_state", "accepted for older specs; nothing is drawn but by row", number(whole=True))
    estimator = param("estimator", "binned or neighbours", one_of("binned", "neighbours"))
    bins = param("bins", "quantile bins per column", number(2, whole=True))
    n_neighbors = param("n_neighbors", "neighbours of a row's own class", number(1, whole=True))
    DEFAULTS = {"k": 20, "random_state": 42, "estimator": "binned", "bins": MI_BINS, "n_neighbors": NEIGHBOURS}

    def _fit(self, df: DataFrame) -> KeepModel:
        columns = self.numeric(df)
        label, scores = self.label(df), {}
        if columns:
            scores = self._scores(df, columns, label)
        best = sorted(columns, key=lambda c: (-scores[c], c))[: self.get("k")]
        others = [c for c in df.columns if c not in columns and c not in self.reserved]
        return self.model(KeepModel, keep=best, others=others, scores=scores)

    def _scores(self, df: DataFrame, columns: list[str], label: str) -> dict[str, float]:
        key = self.get("idCol") if self.get("idCol") in df.columns else None
        with scratch_scope(df.sparkSession):
            read = [*columns, label, *([key] if key else [])]
            numbers, _ = write_table(df.select(*[col(c) for c in read]))  # read several times
            if self.get("estimator") == "binned":
                return mutual_information(numbers, columns, label, self.get("bins"))
            return neighbour_information(numbers, columns, label, k=self.get("n_neighbors"), id_col=key)


def percentile(values: list[float], q: float) -> float:
    """Linear-interpolated percentile of a short list."""
    ordered = sorted(values)
    at = (len(ordered) - 1) * q / 100
    low = math.floor(at)
    high = min(low + 1, len(ordered) - 1)
    return ordered[low] + (ordered[high] - ordered[low]) * (at - low)


class TreeImportance(Configured, Estimator, Persisted):
    """Fit a quick boosted model and keep the numeric columns above an importance percentile."""

    importance_type = param("importance_type", "gain", one_of("gain"))
    percentile_cutoff = param("percentile_cutoff", "importance percentile to reach", number(0, 100))
    n_estimators = param("n_estimators", "boosting rounds", number(1, whole=True))
    max_depth = param("max_depth", "tree depth", number(1, whole=True))
    DEFAULTS = {"importance_type": "gain", "percentile_cutoff": 10.0, "n_estimators": 100, "max_depth": 4}

    def _fit(self, df: DataFrame) -> KeepModel:
        from millrace.operators.models import XGB_RATE, BoostedTrees

        label, columns = self.label(df), self.numeric(df)
        others = [c for c in df.columns if c not in columns and c not in self.reserved]
        if not columns:
            return self.model(KeepModel, keep=[], others=others, scores={})
        quick = BoostedTrees(
            labelCol=label,
            n_estimators=self.get("n_estimators"),
            max_depth=self.get("max_depth"),
            learning_rate=XGB_RATE,
            subsample=1.0,
            colsample_bytree=1.0,
        ).fit(df.select(*[col(c) for c in [*columns, label]]))
        scores: dict[str, Any] = dict.fromkeys(columns, 0.0)
        for name, value in quick.importances().items():
            scores[quick.source_column(name)] += value
        cutoff = percentile(list(scores.values()), self.get("percentile_cutoff"))
        keep = [c for c in columns if scores[c] >= cutoff]
        return self.model(KeepModel, keep=keep, others=others, scores=scores)
