"""The data tables behind the charts: small, ordered, ready to draw."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.metrics import COSTS, LABELS, class_metrics, confusion_matrix
from millrace.operators.profile import label_distribution


def class_shares(df: DataFrame, label_col: str, labels: list[str] | None = None) -> DataFrame:
    """Count and share of all rows per configured class, absent classes left out."""
    labels = LABELS if labels is None else labels
    position = F.array_position(F.array(*[F.lit(c) for c in labels]), F.col("label")).cast("int")
    return (
        label_distribution(df, label_col)
        .withColumn("position", position)
        .filter("position > 0")
        .orderBy("position")
    )


def model_comparison(spark: SparkSession, results: dict[str, dict[str, float]]) -> DataFrame:
    """model x {accuracy, f1_macro}, long form."""
    rows = [(m, metric, float(r[metric])) for m, r in results.items() for metric in ("accuracy", "f1_macro")]
    return spark.createDataFrame(rows, "model string, metric string, value double")


def class_metrics_long(counts: DataFrame, labels: list[str] | None = None) -> DataFrame:
    """label x {precision, recall, f1}, long form."""
    return (
        class_metrics(counts, labels)
        .drop("support")
        .unpivot(["label"], ["precision", "recall", "f1"], "metric", "value")
    )


def confusion_shares(counts: DataFrame, labels: list[str] | None = None) -> DataFrame:
    """Confusion matrix with every row divided by its sum; a class without rows gives nulls."""
    labels = LABELS if labels is None else labels
    matrix = confusion_matrix(counts, labels)
    cells = [F.col(f"`{c}`") for c in labels]
    total = sum(cells[1:], cells[0])
    return matrix.select("true_label", *[F.try_divide(x, total).alias(c) for c, x in zip(labels, cells)])


def cost_table(
    spark: SparkSession, labels: list[str] | None = None, costs: list[list[float]] | None = None
) -> DataFrame:
    labels, costs = labels or LABELS, costs or COSTS
    rows = [(t, p, float(costs[i][j])) for i, t in enumerate(labels) for j, p in enumerate(labels)]
    return spark.createDataFrame(rows, "true_label string, predicted string, cost double")


def top_importances(spark: SparkSession, importances: dict[str, float], n: int = 20) -> DataFrame:
    """The n features that matter most, most important first."""
    rows = sorted(importances.items(), key=lambda kv: (-kv[1], kv[0]))[:n]
    return spark.createDataFrame([(f, float(v)) for f, v in rows], "feature string, importance double")
