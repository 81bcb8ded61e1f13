"""Hyper-parameter search: trials proposed from the scores so far, scored by cross-validated F1."""

from __future__ import annotations

import logging
import statistics
import time
from typing import Any

from pyspark.sql import DataFrame

from millrace.functions.columns import class_counts, in_parallel
from millrace.operators.split import labelled, with_folds
from millrace.plans.sampler import SPACES, DensitySampler, Range
from millrace.plans.spec import build_pipeline, read_spec
from millrace.plans.validate import PARALLEL_FITS, PreparedFolds, fold_scores
from millrace.sources.scratch import scratch_scope, write_table

log = logging.getLogger(__name__)


def tune(
    spec: str | dict[str, Any],
    df: DataFrame,
    id_col: str,
    label_col: str,
    *,
    n_trials: int = 40,
    cv_folds: int = 3,
    timeout: float | None = None,
    seed: int = 42,
    spaces: dict[str, dict[str, Range]] | None = None,
    parallelism: int = PARALLEL_FITS,
    trials_at_once: int = 1,
) -> dict[str, Any]:
    """The spec with the best parameters found, renamed ``{name}_tuned``.

    All trials see the same folds, written once and prepared once: only the model is fitted per
    trial. ``trials_at_once`` trials run side by side; the next ones are proposed when all of them
    are done, so the result hangs on the seed alone. No trial starts after ``timeout`` seconds, but
    the first ones always run. No table is left behind.
    """
    base = read_spec(spec)
    spaces = SPACES if spaces is None else spaces
    kind = base["model"]["type"] if base["model"] else None
    if kind not in spaces:
        raise ValueError(f"no search space for model type '{kind}'; supported: {sorted(spaces)}")
    if n_trials < 1 or cv_folds < 2 or trials_at_once < 1:
        raise ValueError("n_trials and trials_at_once must be at least 1 and cv_folds at least 2")
    known = labelled(df, label_col)
    classes = [c for c, _ in class_counts(known, label_col)]
    sampler = DensitySampler(spaces[kind], seed)
    trials: list[tuple[dict[str, Any], float | None]] = []
    started = time.monotonic()
    with scratch_scope(df.sparkSession):
        folded, _ = write_table(with_folds(known, id_col, label_col, n_splits=cv_folds, seed=seed))
        folds = PreparedFolds(folded, cv_folds)

        def score(params: dict[str, Any]) -> float:
            pipeline = build_pipeline({**base, "model": {"type": kind, **params}}, id_col=id_col, label_col=label_col)
            found = fold_scores(pipeline, folds, label_col, labels=classes, costs=None, parallelism=parallelism)
            return statistics.fmean(f["f1_macro"] for f in found)

        while len(trials) < n_trials:
            if trials and timeout is not None and time.monotonic() - started > timeout:
                break
            running: list[dict[str, Any]] = []
            for _ in range(min(trials_at_once, n_trials - len(trials))):
                running.append(sampler.propose([*trials, *[(p, None) for p in running]]))
            jobs = [lambda p=p: score(p) for p in running]
            trials += zip(running, in_parallel(df.sparkSession, jobs, trials_at_once), strict=True)
    best, reached = max(trials, key=lambda t: t[1])  # of equal scores the first
    log.info("search done after %d trials: best F1 macro %.4f with %s", len(trials), reached, best)
    return {**base, "name": f"{base['name']}_tuned", "model": {"type": kind, **best}}
