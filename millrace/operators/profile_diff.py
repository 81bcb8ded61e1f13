"""What a preparation changed: two profiles compared report by report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _both(before: DataFrame, after: DataFrame, columns: list[str]) -> DataFrame:
    """Outer join of two reports on the column name, one suffix per side."""
    left = before.select("column", *[F.col(c).alias(f"{c}_before") for c in columns])
    right = after.select("column", *[F.col(c).alias(f"{c}_after") for c in columns])
    return left.join(right, "column", "full_outer")


def _largest_change(df: DataFrame, change: str) -> DataFrame:
    return df.orderBy(F.desc_nulls_last(F.abs(F.col(change))), "column")


def diff_missing(before: DataFrame, after: DataFrame) -> DataFrame:
    both = _both(before, after, ["pct_missing"])
    change = F.col("pct_missing_after") - F.col("pct_missing_before")
    return _largest_change(both.withColumn("pct_change", change), "pct_change")


def diff_cardinality(before: DataFrame, after: DataFrame) -> DataFrame:
    both = _both(before, after, ["n_unique", "suggested_encoding"])
    same = F.col("suggested_encoding_before").eqNullSafe(F.col("suggested_encoding_after"))
    return both.withColumn("encoding_changed", ~same).orderBy("column")


def diff_distribution(before: DataFrame, after: DataFrame) -> DataFrame:
    both = _both(before, after, ["mean", "std", "skew"])
    return _largest_change(both.withColumn("skew_change", F.col("skew_after") - F.col("skew_before")), "skew_change")


def diff_dtypes(before: DataFrame, after: DataFrame) -> DataFrame:
    def flagged(side: str) -> Column:
        return F.coalesce(F.col(f"flagged_{side}"), F.lit(False))

    both = _both(before, after, ["flagged", "suspected_dtype"])
    return both.filter(flagged("before") | flagged("after")).orderBy("column")


def diff_redundancy(before: DataFrame, after: DataFrame) -> DataFrame:
    """Pairs present in both reports (with the earlier correlation), only before, only after."""

    def pairs(report: DataFrame, value: str) -> DataFrame:
        return report.select(
            F.least("col_a", "col_b").alias("col_a"),
            F.greatest("col_a", "col_b").alias("col_b"),
            F.col("correlation").alias(value),
        )

    both = pairs(before, "old").join(pairs(after, "new"), ["col_a", "col_b"], "full_outer")
    status = (
        F.when(F.col("new").isNull(), "resolved").when(F.col("old").isNull(), "new").otherwise("unchanged")
    )
    return both.select(
        "col_a", "col_b", F.coalesce("old", "new").alias("correlation"), status.alias("status")
    ).orderBy("status", "col_a", "col_b")


DIFFS = {
    "missing": diff_missing,
    "cardinality": diff_cardinality,
    "distribution": diff_distribution,
    "dtype_audit": diff_dtypes,
    "redundancy": diff_redundancy,
}


def diff_profiles(before: dict[str, DataFrame], after: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {name: diff(before[name], after[name]) for name, diff in DIFFS.items()}


def most_changed_missing(diff: DataFrame, n: int = 10) -> DataFrame:
    """Columns whose missing share changed, largest change first."""
    return _largest_change(diff.filter("pct_change <> 0"), "pct_change").limit(n)


def changed_encodings(diff: DataFrame) -> DataFrame:
    return diff.filter("encoding_changed").drop("encoding_changed")
