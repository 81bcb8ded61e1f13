"""Cross-validated and hold-out evaluation."""

from __future__ import annotations

import json
import statistics
from threading import Lock
from typing import Any

from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import col, in_parallel
from millrace.operators.metrics import COSTS, LABELS, pair_counts, scores
from millrace.operators.split import labelled, with_folds
from millrace.sources.scratch import scratch_scope, write_table

SCORES = ("accuracy", "f1_macro", "f1_weighted", "cost")
PARALLEL_FITS = 2


def holdout_eval(
    fitted: PipelineModel,
    df: DataFrame,
    label_col: str,
    *,
    labels: list[Any] | None = None,
    costs: list[list[float]] | None = None,
) -> dict[str, float]:
    """Score a fitted pipeline on labelled rows, without refitting."""
    labels, costs = labels or LABELS, costs or COSTS
    # selectors may drop nothing of the label, so it is still there next to the prediction
    found = scores(pair_counts(fitted.transform(df), label_col), labels, costs)
    return {k: float(found[k]) for k in SCORES}


class PreparedFolds:
    """Every fold's training and held-out rows as the stages before a model leave them.

    The stages are fitted on a fold's training rows alone, once for each fold and list of stages,
    and what they make of both sides is written. Whoever asks for the same stages again, from any
    thread, reads the written tables.
    """

    def __init__(self, folded: DataFrame, n_splits: int, fold_col: str = "fold") -> None:
        self.folded, self.n_splits, self.fold_col = folded, n_splits, fold_col
        self._tables: dict[tuple[str, int], tuple[DataFrame, DataFrame]] = {}
        self._locks: dict[tuple[str, int], Lock] = {}
        self._lock = Lock()

    def of(self, stages: list[Any], fold: int) -> tuple[DataFrame, DataFrame]:
        """Prepared training and held-out rows of a fold."""
        key = (_described(stages), fold)
        with self._lock:
            own = self._locks.setdefault(key, Lock())
        with own:
            if key not in self._tables:
                self._tables[key] = self._prepared(stages, fold)
            return self._tables[key]

    def _prepared(self, stages: list[Any], fold: int) -> tuple[DataFrame, DataFrame]:
        train = self.folded.filter(col(self.fold_col) != fold).drop(self.fold_col)
        held = self.folded.filter(col(self.fold_col) == fold).drop(self.fold_col)
        if not stages:
            return train, held
        fitted = Pipeline(stages=stages).copy().fit(train)
        return write_table(fitted.transform(train))[0], write_table(fitted.transform(held))[0]


def _described(stages: list[Any]) -> str:
    """Kinds and parameters of the stages, in order: equal texts stand for equal fits."""
    return json.dumps([[type(s).__name__, {p.name: s.getOrDefault(p) for p in s.params if s.isDefined(p)}] for s in stages], sort_keys=True, default=str)


def fold_scores(
    pipeline: Pipeline,
    folds: PreparedFolds,
    label_col: str,
    *,
    labels: list[Any],
    costs: list[list[float]] | None,
    parallelism: int = PARALLEL_FITS,
) -> list[dict[str, Any]]:
    """Per fold: fit a fresh copy of the last stage on the prepared other folds, score it on this one."""
    *before, last = pipeline.getStages()

    def run(fold: int):
        train, held = folds.of(before, fold)
        fitted = Pipeline(stages=[last]).copy().fit(train)
        return scores(pair_counts(fitted.transform(held), label_col), labels, costs)

    jobs = [lambda fold=fold: run(fold) for fold in range(folds.n_splits)]
    return in_parallel(folds.folded.sparkSession, jobs, parallelism)


def cross_val_eval(
    pipeline: Pipeline,
    df: DataFrame,
    id_col: str,
    label_col: str,
    *,
    n_splits: int = 5,
    seed: int = 42,
    labels: list[Any] | None = None,
    costs: list[list[float]] | None = None,
    parallelism: int = PARALLEL_FITS,
) -> dict[str, float]:
    """Mean and population deviation of every score over stratified folds.

    The input is written once with its fold numbers, so that the reads and joins behind it
    are not repeated by every stage of every fold. No table is left behind.
    """
    labels, costs = labels or LABELS, costs or COSTS
    with scratch_scope(df.sparkSession):
        folded, _ = write_table(with_folds(labelled(df, label_col), id_col, label_col, n_splits=n_splits, seed=seed))
        found = fold_scores(
            pipeline, PreparedFolds(folded, n_splits), label_col, labels=labels, costs=costs, parallelism=parallelism
        )
    out: dict[str, float] = {}
    for k in SCORES:
        values = [float(f[k]) for f in found]
        out[f"{k}_mean"] = statistics.fmean(values)
        out[f"{k}_std"] = statistics.pstdev(values)
    return out


def scores_table(df: DataFrame, results: dict[str, float]) -> DataFrame:
    """Scores as rows, by name."""
    rows = sorted((k, float(v)) for k, v in results.items())
    return df.sparkSession.createDataFrame(rows, "score string, value double").orderBy(F.col("score"))
