"""The jobs: split, diagnose, train, evaluate, predict, chart tables."""

from __future__ import annotations

from typing import Any

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from millrace.operators import charts
from millrace.operators.derive import map_points, map_sample
from millrace.operators.metrics import LABELS, pair_counts, scores
from millrace.operators.profile import REDUNDANCY, profile
from millrace.operators.profile_diff import diff_profiles
from millrace.operators.split import split_summary, stratified_split
from millrace.plans import store
from millrace.plans.spec import baseline_spec, build_pipeline, model_step, needs_label, read_spec, without_model
from millrace.plans.tune import tune
from millrace.plans.validate import cross_val_eval, holdout_eval
from millrace.sources.scratch import scratch_scope, write_table
from millrace.sources.sinks import write_predictions, write_reports, write_split
from millrace.sources.tables import read_dataset, read_features

ID, LABEL = "id", "status_group"


def split(
    spark: SparkSession,
    features_path: str,
    labels_path: str,
    output_dir: str,
    *,
    test_size: float = 0.2,
    seed: int = 42,
    id_col: str = ID,
    label_col: str = LABEL,
    fmt: str = "parquet",
) -> DataFrame:
    """Stratified split written as four tables; returns the class shares of both sides."""
    data = read_dataset(spark, features_path, labels_path, id_col=id_col, label_col=label_col)
    data, _ = write_table(data)
    train, test = stratified_split(data, id_col, label_col, test_size=test_size, seed=seed)
    write_split(train, test, output_dir, id_col=id_col, label_col=label_col, fmt=fmt)
    return split_summary(train, test, label_col)


def profile_diff(
    df: DataFrame,
    spec: str | dict[str, Any],
    *,
    id_col: str = ID,
    label_col: str | None = LABEL,
    redundancy_threshold: float = REDUNDANCY,
) -> dict[str, dict[str, DataFrame]]:
    """Profile raw rows, run the preparation without its model, profile again, compare."""
    if needs_label(without_model(spec)) and (label_col is None or label_col not in df.columns):
        raise ValueError("this spec has a supervised step: labels are required")
    before = profile(df, label_col, id_col=id_col, redundancy_threshold=redundancy_threshold)
    pipeline = build_pipeline(without_model(spec), id_col=id_col, label_col=label_col)
    prepared, _ = write_table(pipeline.fit(df).transform(df).drop(*[c for c in [id_col, label_col] if c]))
    after = profile(prepared, redundancy_threshold=redundancy_threshold)
    return {"before": before, "after": after, "diff": diff_profiles(before, after)}


def diagnose(
    spark: SparkSession,
    features_path: str,
    labels_path: str | None = None,
    *,
    spec: str | dict[str, Any] | None = None,
    output_dir: str | None = None,
    redundancy_threshold: float = REDUNDANCY,
    id_col: str = ID,
    label_col: str = LABEL,
) -> dict[str, dict[str, DataFrame]]:
    """Reports before, and with a spec also after preparation and their differences."""
    if labels_path is None:
        data = read_features(spark, features_path, id_col=id_col)
    else:
        data = read_dataset(spark, features_path, labels_path, id_col=id_col, label_col=label_col)
    data, _ = write_table(data)
    present = label_col if labels_path is not None else None
    if spec is None:
        reports = {"before": profile(data, present, id_col=id_col, redundancy_threshold=redundancy_threshold)}
    else:
        reports = profile_diff(
            data, spec, id_col=id_col, label_col=present, redundancy_threshold=redundancy_threshold
        )
    if output_dir is not None:
        for prefix, found in reports.items():
            write_reports(found, output_dir, prefix)
    return reports


def train(
    spark: SparkSession,
    features_path: str,
    labels_path: str,
    models_dir: str,
    *,
    spec: str | dict[str, Any] | None = None,
    name: str | None = None,
    optimize: bool = False,
    n_trials: int = 40,
    cv_folds: int = 3,
    timeout: float | None = None,
    seed: int = 42,
    id_col: str = ID,
    label_col: str = LABEL,
) -> str:
    """Fit a spec (the baseline if none is given), tuned on request; returns the saved stem.

    ``timeout`` (seconds) and ``seed`` are the search's.
    """
    found = read_spec(spec if spec is not None else baseline_spec())
    if name is not None:
        found["name"] = name
    if found["model"] is None:
        raise ValueError("the spec has no model; training needs one")
    with scratch_scope(spark):
        data, _ = write_table(read_dataset(spark, features_path, labels_path, id_col=id_col, label_col=label_col))
        if optimize:
            found = tune(found, data, id_col, label_col, n_trials=n_trials, cv_folds=cv_folds, timeout=timeout, seed=seed)
        fitted = build_pipeline(found, id_col=id_col, label_col=label_col).fit(data)
        return store.save(spark, fitted, found["name"], models_dir, spec=found)


def _stem(spark: SparkSession, model: str, models_dir: str, latest: bool) -> str:
    return store.latest_stem(spark, model, models_dir) if latest else model


def evaluate(
    spark: SparkSession,
    model: str,
    features_path: str,
    labels_path: str,
    models_dir: str,
    *,
    latest: bool = False,
    holdout: bool = False,
    n_splits: int = 5,
    labels: list[Any] | None = None,
    costs: list[list[float]] | None = None,
    id_col: str = ID,
    label_col: str = LABEL,
) -> dict[str, float]:
    """Score a stored model on held-out rows, or cross-validate the spec it was built from."""
    stem = _stem(spark, model, models_dir, latest)
    with scratch_scope(spark):
        data, _ = write_table(read_dataset(spark, features_path, labels_path, id_col=id_col, label_col=label_col))
        if holdout:
            fitted = store.load(spark, stem, models_dir)
            return holdout_eval(fitted, data, label_col, labels=labels, costs=costs)
        pipeline = build_pipeline(store.load_spec(spark, stem, models_dir), id_col=id_col, label_col=label_col)
        return cross_val_eval(pipeline, data, id_col, label_col, n_splits=n_splits, labels=labels, costs=costs)


def predict(
    spark: SparkSession,
    model: str,
    features_path: str,
    models_dir: str,
    output: str | None = None,
    *,
    latest: bool = False,
    id_col: str = ID,
    output_col: str = LABEL,
    fmt: str = "csv",
) -> str:
    """Predict every row of a feature table with a stored model and write id and class; returns the path.

    Without ``output`` the predictions go beside the models' folder, named after the model asked for.
    """
    features = read_features(spark, features_path, id_col=id_col)
    fitted = store.load(spark, _stem(spark, model, models_dir, latest), models_dir)
    scored = fitted.transform(features)
    output = output or f"{models_dir.rstrip('/')}-predictions/submission_{model}"
    return write_predictions(scored, output, id_col=id_col, output_col=output_col, fmt=fmt)


def chart_tables(
    spark: SparkSession,
    models: dict[str, PipelineModel],
    df: DataFrame,
    *,
    id_col: str = ID,
    label_col: str = LABEL,
    labels: list[str] | None = None,
    costs: list[list[float]] | None = None,
    lat_col: str | None = None,
    lon_col: str | None = None,
    top_n: int = 20,
) -> dict[str, DataFrame]:
    """Everything the charts of one or more fitted models are drawn from."""
    labels = labels or LABELS
    out = {
        "class_shares": charts.class_shares(df, label_col, labels),
        "cost_matrix": charts.cost_table(spark, labels, costs),
    }
    results = {}
    on_map = bool(lat_col and lon_col)
    if on_map:
        sample, _ = write_table(map_sample(df, id_col=id_col, lat_col=lat_col, lon_col=lon_col))
    for name, fitted in models.items():
        counts, _ = write_table(pair_counts(fitted.transform(df), label_col))
        results[name] = scores(counts, labels)
        out[f"confusion_{name}"] = charts.confusion_shares(counts, labels)
        out[f"per_class_{name}"] = charts.class_metrics_long(counts, labels)
        out[f"importances_{name}"] = charts.top_importances(spark, model_step(fitted).importances(), top_n)
        if on_map:
            # only the sampled rows are scored for it; preparation may drop or refill the coordinates: take the raw ones
            predicted = fitted.transform(sample).select(id_col, "prediction")
            located = sample.select(id_col, lat_col, lon_col).join(predicted, id_col)
            out[f"map_{name}"] = map_points(located, id_col=id_col, lat_col=lat_col, lon_col=lon_col)
    out["model_comparison"] = charts.model_comparison(spark, results)
    return out
