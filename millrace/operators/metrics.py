"""Scores of predictions, all derived from one count of (true, predicted) pairs."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import MAX_CLASSES, col

# The domain's classes in report order and its costs, row = true, column = predicted.
LABELS = ["functional", "functional needs repair", "non functional"]
COSTS = [
    [0.0, 1.0, 3.0],
    [2.0, 0.0, 2.0],
    [5.0, 3.0, 0.0],
]


def pair_counts(df: DataFrame, label_col: str, prediction_col: str = "prediction") -> DataFrame:
    """Rows per (true_label, predicted); the only pass over the predictions."""
    return df.groupBy(col(label_col).alias("true_label"), col(prediction_col).alias("predicted")).agg(
        F.count(F.lit(1)).alias("n")
    )


@dataclass
class _Sums:
    """Rows of one class: with this label, with this prediction, with both; and the cost of its label's rows."""

    support: int = 0
    claimed: int = 0
    hit: int = 0
    cost: float = 0.0


def _sums(counts: DataFrame, labels: list[Any], costs: list[list[float]] | None = None) -> dict[Any, _Sums]:
    """Sums by class, in one pass over the pairs: a row per class reaches the driver, after a check of their number."""
    true, n = F.col("true_label"), F.col("n")
    predicted = F.col("predicted").cast(counts.schema["true_label"].dataType)
    none = F.lit(0).cast("bigint")
    cost = F.lit(0.0)
    if costs is not None:
        at = F.create_map(*[F.lit(x) for i, c in enumerate(labels) for x in (c, i)])
        table = F.array(*[F.array(*[F.lit(float(x)) for x in row]) for row in costs])
        cost = F.coalesce(F.get(F.get(table, F.try_element_at(at, true)), F.try_element_at(at, predicted)), F.lit(0.0)) * n
    sides = F.array(
        F.struct(true.alias("label"), n.alias("support"), none.alias("claimed"), F.when(true.eqNullSafe(predicted), n).otherwise(none).alias("hit"), cost.alias("cost")),
        F.struct(predicted.alias("label"), none.alias("support"), n.alias("claimed"), none.alias("hit"), F.lit(0.0).alias("cost")),
    )
    by_class = counts.select(F.explode(sides).alias("s")).select("s.*").groupBy("label").agg(*[F.sum(c).alias(c) for c in ("support", "claimed", "hit", "cost")])
    rows = by_class.limit(MAX_CLASSES + 1).collect()
    if len(rows) > MAX_CLASSES:
        raise ValueError(f"more than {MAX_CLASSES} classes; these are not class labels")
    found = {r["label"]: _Sums(r["support"], r["claimed"], r["hit"], r["cost"]) for r in rows}
    unknown = [] if costs is None else [c for c in found if c not in labels]
    if unknown:
        raise ValueError(f"labels without a cost: {sorted(map(str, unknown))[:20]}")
    return found


def _share(part: float, whole: float) -> float:
    return part / whole if whole else 0.0


def _per_class(sums: dict[Any, _Sums], labels: list[Any]) -> dict[Any, dict[str, float]]:
    out = {}
    for c in labels:
        own = sums.get(c, _Sums())
        out[c] = {
            "precision": _share(own.hit, own.claimed),
            "recall": _share(own.hit, own.support),
            "f1": _share(2 * own.hit, own.support + own.claimed),
            "support": own.support,
        }
    return out


def scores(counts: DataFrame, labels: list[Any] | None = None, costs: list[list[float]] | None = None) -> dict[str, Any]:
    """accuracy, f1_macro, f1_weighted, per_class; and cost if ``costs`` is given."""
    labels = LABELS if labels is None else labels
    sums = _sums(counts, labels, costs)
    per_class = _per_class(sums, labels)
    support = sum(s["support"] for s in per_class.values())
    out = {
        "accuracy": _share(sum(s.hit for s in sums.values()), sum(s.support for s in sums.values())),
        "f1_macro": _share(sum(s["f1"] for s in per_class.values()), len(labels)),
        "f1_weighted": _share(sum(s["f1"] * s["support"] for s in per_class.values()), support),
        "per_class": per_class,
    }
    if costs is not None:
        out["cost"] = sum(s.cost for s in sums.values())
    return out


def cost_score(
    df: DataFrame,
    label_col: str,
    prediction_col: str = "prediction",
    *,
    labels: list[Any] | None = None,
    costs: list[list[float]] | None = None,
) -> float:
    """Total cost of all predictions; a label outside the matrix is an error."""
    counts = pair_counts(df, label_col, prediction_col)
    sums = _sums(counts, LABELS if labels is None else labels, COSTS if costs is None else costs)
    return float(sum(s.cost for s in sums.values()))


def class_metrics(counts: DataFrame, labels: list[str] | None = None) -> DataFrame:
    """One row per configured label: precision, recall, f1, support."""
    labels = LABELS if labels is None else labels
    found = _per_class(_sums(counts, labels), labels)
    rows = [(c, s["precision"], s["recall"], s["f1"], s["support"]) for c, s in found.items()]
    schema = "label string, precision double, recall double, f1 double, support long"
    return counts.sparkSession.createDataFrame(rows, schema)


def confusion_matrix(counts: DataFrame, labels: list[str] | None = None) -> DataFrame:
    """Rows = true label, one column per predicted label, in configured order, zero-filled."""
    labels = LABELS if labels is None else labels
    known = counts.filter(F.col("true_label").isin(labels) & F.col("predicted").isin(labels))
    pairs = {(r["true_label"], r["predicted"]): r["n"] for r in known.collect()}  # the cells of the result
    rows = [(t, *[pairs.get((t, p), 0) for p in labels]) for t in labels]
    schema = ", ".join(["true_label string", *[f"`{p}` long" for p in labels]])
    return counts.sparkSession.createDataFrame(rows, schema)
