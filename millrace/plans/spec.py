"""A pipeline described as a dict or JSON, and the ``pyspark.ml`` Pipeline it stands for."""

from __future__ import annotations

import copy
import json
from collections import Counter
from typing import Any

from pyspark.ml import Pipeline, PipelineModel

from millrace.operators.base import Configured
from millrace.operators.clean import CategoricalImputer, ColumnDropper, NumericImputer, ZeroToNull
from millrace.operators.derive import GeoCluster, YearGap
from millrace.operators.encode import FrequencyEncoder, OrdinalEncoder, TargetEncoder
from millrace.operators.models import BoostedTrees, LeafLimitedTrees, LogisticClassifier, RandomForest
from millrace.operators.select import CorrelationThreshold, MutualInformation, TreeImportance, VarianceThreshold

# The step and model names used in specs.
STEPS: dict[str, type[Configured]] = {
    "zero_to_nan": ZeroToNull,
    "numeric_imputer": NumericImputer,
    "categorical_imputer": CategoricalImputer,
    "ordinal_encoder": OrdinalEncoder,
    "target_encoder": TargetEncoder,
    "redundant_dropper": ColumnDropper,
    "pump_age": YearGap,
    "geo_cluster": GeoCluster,
    "frequency_encoder": FrequencyEncoder,
    "variance_threshold": VarianceThreshold,
    "correlation_threshold": CorrelationThreshold,
    "mutual_info": MutualInformation,
    "xgb_importance": TreeImportance,
}
MODELS: dict[str, type[Configured]] = {
    "logistic_regression": LogisticClassifier,
    "random_forest": RandomForest,
    "xgb": BoostedTrees,
    "lgbm": LeafLimitedTrees,
}
SUPERVISED = {"target_encoder", "mutual_info", "xgb_importance"}

# Columns of the domain table that the full specs leave out of the model.
DROPPED_BY_SPECS = [
    "extraction_type_group",
    "extraction_type_class",
    "payment_type",
    "quantity_group",
    "quality_group",
    "source_type",
    "source_class",
    "waterpoint_type_group",
    "recorded_by",
    "wpt_name",
    "num_private",
    "region_code",
    "district_code",
    "subvillage",
    "scheme_name",
    "scheme_management",
    "ward",
    "date_recorded",
    "lga",
    "region",
    "amount_tsh",
    "management",
    "construction_year",
]
FLAG_COLUMNS = ["public_meeting", "permit"]
HIGH_CARDINALITY = ["funder", "installer"]


def read_spec(spec: str | dict[str, Any]) -> dict[str, Any]:
    """Checked copy of a spec given as a dict or as JSON text."""
    found = json.loads(spec) if isinstance(spec, str) else copy.deepcopy(spec)
    unknown = set(found) - {"name", "preprocessing", "features", "model"}
    if unknown:
        raise ValueError(f"unknown spec entries: {sorted(unknown)}")
    if not isinstance(found.get("name"), str) or not found["name"]:
        raise ValueError("a spec needs a name")
    found.setdefault("preprocessing", [])
    found.setdefault("features", [])
    found.setdefault("model", None)
    for step in [*found["preprocessing"], *found["features"], *([found["model"]] if found["model"] else [])]:
        if "type" not in step:
            raise ValueError(f"a step needs a type: {step}")
    return found


def _stage(step: dict[str, Any], kinds: dict[str, type[Configured]], **keys: str | None) -> Configured:
    params = dict(step)
    kind = params.pop("type")
    if kind not in kinds:
        raise KeyError(f"unknown step type '{kind}'; known: {sorted(kinds)}")
    return kinds[kind](**params, **keys)


def build_pipeline(
    spec: str | dict[str, Any], *, id_col: str | None = "id", label_col: str | None = "status_group"
) -> Pipeline:
    """Preparation, features, then the model; stages are named after their step type."""
    found = read_spec(spec)
    keys = {"idCol": id_col, "labelCol": label_col}
    stages, seen = [], Counter()
    for step in [*found["preprocessing"], *found["features"]]:
        stage = _stage(step, STEPS, **keys)
        kind = step["type"]
        stage._resetUid(kind if not seen[kind] else f"{kind}_{seen[kind]}")
        seen[kind] += 1
        stages.append(stage)
    if found["model"] is not None:
        model = _stage(found["model"], MODELS, **keys)
        model._resetUid("model")
        stages.append(model)
    return Pipeline(stages=stages)


def step_names(pipeline: Pipeline) -> list[str]:
    return [s.uid for s in pipeline.getStages()]


def model_step(fitted: PipelineModel):
    """The fitted classifier; an error if the pipeline has none."""
    last = fitted.stages[-1] if fitted.stages else None
    if last is None or not hasattr(last, "importances"):
        raise ValueError("the pipeline has no 'model' step")
    return last


def without_model(spec: str | dict[str, Any]) -> dict[str, Any]:
    return {**read_spec(spec), "model": None}


def needs_label(spec: str | dict[str, Any]) -> bool:
    found = read_spec(spec)
    steps = [*found["preprocessing"], *found["features"]]
    return found["model"] is not None or any(s["type"] in SUPERVISED for s in steps)


def baseline_spec() -> dict[str, Any]:
    """Used when a job is given no spec. The year gap comes before imputing and encoding."""
    return {
        "name": "xgb_baseline",
        "preprocessing": [
            {"type": "redundant_dropper"},
            {"type": "zero_to_nan"},
            {"type": "pump_age"},
            {"type": "numeric_imputer"},
            {"type": "categorical_imputer"},
            {"type": "ordinal_encoder"},
        ],
        "features": [],
        "model": {"type": "xgb"},
    }


def full_spec(model: str | None = None, **params: Any) -> dict[str, Any]:
    """The domain's full preparation with one of the models (None: preparation only).

    Unused columns go first, so that no later fit aggregates them; the two the year gap
    reads go right after it.
    """
    late = ["date_recorded", "construction_year"]
    return {
        "name": model or "preprocessing",
        "preprocessing": [
            {"type": "redundant_dropper", "columns_to_drop": [c for c in DROPPED_BY_SPECS if c not in late]},
            {"type": "zero_to_nan"},
            {"type": "pump_age"},
            {"type": "redundant_dropper", "columns_to_drop": late},
            {"type": "numeric_imputer", "strategy": "median"},
            {"type": "categorical_imputer", "strategy": "most_frequent", "columns": FLAG_COLUMNS},
            {"type": "target_encoder", "columns": HIGH_CARDINALITY, "smoothing": 1.0},
            {"type": "ordinal_encoder"},
        ],
        "features": [
            {"type": "geo_cluster", "n_clusters": 20},
            {"type": "variance_threshold", "threshold": 0.01},
            {"type": "correlation_threshold", "threshold": 0.95, "method": "spearman"},
        ],
        "model": None if model is None else {"type": model, **params},
    }
