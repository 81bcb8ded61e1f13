"""Dropping columns, sentinels to null, and filling missing values."""

from __future__ import annotations

import logging

from pyspark.ml import Estimator, Transformer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import as_double, col
from millrace.functions.quantiles import exact_quantiles
from millrace.functions.values import long_form
from millrace.operators.base import Configured, Fitted, Persisted, names, number, one_of, param, text

log = logging.getLogger(__name__)

# Default columns of the domain table.
ZERO_MEANS_MISSING = ["construction_year", "gps_height", "population"]
REDUNDANT_COLUMNS = [
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
]


class ColumnDropper(Configured, Transformer, Persisted):
    """Drop listed columns; absent ones are skipped, id and label are refused."""

    columns_to_drop = param("columns_to_drop", "columns to drop", names)
    DEFAULTS = {"columns_to_drop": REDUNDANT_COLUMNS}

    def _transform(self, df: DataFrame) -> DataFrame:
        drop = self.get("columns_to_drop")
        kept = set(drop) & set(self.reserved)
        if kept:
            raise ValueError(f"cannot drop the id or label column: {sorted(kept)}")
        return df.drop(*drop)


class ZeroToNull(Configured, Transformer, Persisted):
    """In listed numeric columns 0 stands for a missing value."""

    columns = param("columns", "columns where 0 means missing", names)
    DEFAULTS = {"columns": ZERO_MEANS_MISSING}

    def _transform(self, df: DataFrame) -> DataFrame:
        present = [c for c in self.numeric(df) if c in set(self.get("columns"))]
        if not present:
            return df
        return df.withColumns({c: F.nullif(col(c), F.lit(0).cast(df.schema[c].dataType)) for c in present})


class NumericImputer(Configured, Estimator, Persisted):
    """Fill numeric columns with a learned median or mean, or a constant."""

    strategy = param("strategy", "median, mean or constant", one_of("mean", "median", "constant"))
    fill_value = param("fill_value", "value of the constant strategy", number())
    columns = param("columns", "columns to fill; empty = all numeric", names)
    approx = param("approx", "take the median from a quantile sketch in one pass", bool)
    DEFAULTS = {"strategy": "median", "fill_value": 0.0, "columns": [], "approx": False}

    def _fit(self, df: DataFrame) -> NumericImputerModel:
        columns = self.chosen_or_numeric(df)
        strategy = self.get("strategy")
        if strategy == "constant" or not columns:
            fills = {c: self.get("fill_value") for c in columns}
        elif strategy == "mean":
            row = df.agg(*[F.avg(as_double(c)).alias(f"m{i}") for i, c in enumerate(columns)]).first()
            fills = {c: row[f"m{i}"] for i, c in enumerate(columns)}
        else:
            medians = exact_quantiles(df, columns, [0.5], approx=self.get("approx"))
            fills = {c: medians[c][0] for c in columns}
        empty = [c for c, v in fills.items() if v is None]
        if empty:
            log.warning("no value to learn from, left missing: %s", empty)
        return self.model(NumericImputerModel, fills=fills)


class NumericImputerModel(Fitted, Persisted):
    def _transform(self, df: DataFrame) -> DataFrame:
        fills = self.learned["fills"]
        return df.withColumns({c: F.coalesce(as_double(c), F.lit(v).cast("double")) for c, v in fills.items()})


class CategoricalImputer(Configured, Estimator, Persisted):
    """Fill text columns with the most frequent value (smallest on ties) or a constant."""

    strategy = param("strategy", "most_frequent or constant", one_of("most_frequent", "constant"))
    fill_value = param("fill_value", "value of the constant strategy and of empty columns", text)
    columns = param("columns", "columns to fill; empty = all text", names)
    DEFAULTS = {"strategy": "most_frequent", "fill_value": "unknown", "columns": []}

    def _fit(self, df: DataFrame) -> CategoricalImputerModel:
        columns = self.chosen_or_text(df)
        fills = dict.fromkeys(columns, self.get("fill_value"))
        if self.get("strategy") == "most_frequent" and columns:
            # counts per value, then one winner per column: both steps fold on the map side
            counts = (
                long_form(df, {c: col(c).cast("string") for c in columns})
                .filter(F.col("value").isNotNull())
                .groupBy("column", "value")
                .agg(F.count(F.lit(1)).alias("n"))
            )
            winners = counts.groupBy("column").agg(F.min(F.struct(-F.col("n"), "value")).alias("top"))
            fills |= {r["column"]: r["top"]["value"] for r in winners.collect()}
        return self.model(CategoricalImputerModel, fills=fills)


class CategoricalImputerModel(Fitted, Persisted):
    def _transform(self, df: DataFrame) -> DataFrame:
        fills = self.learned["fills"]
        return df.withColumns(
            {c: F.coalesce(col(c), F.lit(v).cast(df.schema[c].dataType)) for c, v in fills.items()}
        )
