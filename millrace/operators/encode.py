"""Category encoders: order, smoothed target mean, frequency.

Each is fitted by one pass that counts the values of all its columns. Up to
``LITERAL_ROWS`` values stay with the model as a literal map, so applying it is a plain
projection; more stay in a written table that is joined by measured size.
"""

from __future__ import annotations

from pyspark.ml import Estimator
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.columns import class_counts, class_index, col
from millrace.functions.ordered import running_total
from millrace.functions.values import LITERAL_ROWS, ValueTable, look_up, row_salt, value_table
from millrace.operators.base import Configured, Persisted, TableFitted, names, number, one_of, param, text
from millrace.sources.scratch import write_table

LONGEST_LITERAL = 200  # a literal map is searched entry by entry

def _as_text(columns: list[str]) -> dict[str, Column]:
    return {c: col(c).cast("string") for c in columns}


class EncoderModel(TableFitted):
    """Replaces or adds columns by looking every value up in the fitted codes."""

    def remember(self, values: ValueTable, codes: DataFrame) -> EncoderModel:
        """Keep ``codes`` (column, value, n, code): literal if short, else as a table."""
        if values.rows <= LITERAL_ROWS * max(1, len(self.learned["columns"])) and values.n_bytes < 1 << 20:
            maps: dict[str, list] = {c: [] for c in self.learned["columns"]}
            for r in codes.select("column", "value", "code").collect():
                if r["value"] is not None:
                    maps[r["column"]].append([r["value"], r["code"]])
            if max(map(len, maps.values())) <= LONGEST_LITERAL:
                self._set(state={**self.learned, "maps": maps})
                return self
        written, _ = write_table(codes.select("column", "value", "n", "code"))
        self.values = values.with_table(written)
        return self

    def coded(self, df: DataFrame, missing: Column, known_only: Column) -> DataFrame:
        """Add ``__code_{i}`` per column: ``missing`` for null, ``known_only`` for unseen values."""
        columns = self.learned["columns"]
        if self.values is None:
            found = {}
            for i, c in enumerate(columns):
                pairs = [F.lit(x) for value, code in self.learned["maps"][c] for x in (value, float(code))]
                table = F.create_map(*pairs) if pairs else F.lit(None).cast("map<string,double>")
                found[f"__code_{i}"] = F.try_element_at(table, col(c).cast("string"))
            out = df.withColumns(found)
        else:
            out, salt = df, row_salt(df, self.get("idCol"))
            for i, c in enumerate(columns):
                code = {f"__code_{i}": F.col("code")}
                out = look_up(out, self.values, c, col(c).cast("string"), code, salt)
        return out.withColumns(
            {
                f"__code_{i}": F.when(col(c).isNull(), missing)
                .otherwise(F.coalesce(F.col(f"__code_{i}"), known_only))
                .cast("double")
                for i, c in enumerate(columns)
            }
        )

    def placed(self, df: DataFrame, coded: DataFrame, targets: dict[str, str]) -> DataFrame:
        """Put each code in its target column, keeping the column order of ``df``."""
        codes = {targets[c]: F.col(f"__code_{i}") for i, c in enumerate(self.learned["columns"])}
        kept = [codes.pop(c).alias(c) if c in codes else col(c) for c in df.columns]
        return coded.select(*kept, *[x.alias(n) for n, x in codes.items()])


class OrdinalEncoder(Configured, Estimator, Persisted):
    """Replace each category by its position in sorted order; nulls stay null."""

    columns = param("columns", "columns to encode; empty = all text", names)
    handle_unknown = param("handle_unknown", "unseen values: code or error", one_of("use_encoded_value", "error"))
    unknown_value = param("unknown_value", "code of unseen values", number(whole=True))
    DEFAULTS = {"columns": [], "handle_unknown": "use_encoded_value", "unknown_value": -1}

    def _fit(self, df: DataFrame) -> OrdinalEncoderModel:
        columns = self.chosen_or_text(df)
        model = self.model(
            OrdinalEncoderModel,
            columns=columns,
            unknown=None if self.get("handle_unknown") == "error" else float(self.get("unknown_value")),
        )
        if not columns:
            return model
        values = value_table(df, _as_text(columns))
        known = values.table.filter(F.col("value").isNotNull())
        numeric = [c for c in columns if isinstance(df.schema[c].dataType, T.NumericType)]
        ordered = known.withColumn(
            "order", F.struct(F.when(F.col("column").isin(numeric), F.col("value").try_cast("double")), "value")
        )
        position = running_total(ordered, values.rows, "column", "order", F.lit(1), "position")
        return model.remember(values, position.withColumn("code", F.col("position").cast("double")))


class OrdinalEncoderModel(EncoderModel):
    def _transform(self, df: DataFrame) -> DataFrame:
        if not self.learned["columns"]:
            return df
        unknown = self.learned["unknown"]
        if unknown is None:
            # checked where the rows are, so that transform itself starts no job
            unseen = F.raise_error(F.lit("found a category that was not seen at fit")).cast("double")
        else:
            unseen = F.lit(unknown)
        coded = self.coded(df, F.lit(None).cast("double"), unseen)
        return self.placed(df, coded, {c: c for c in self.learned["columns"]})


class TargetEncoder(Configured, Estimator, Persisted):
    """Replace each category by its target mean, shrunk towards the global mean."""

    columns = param("columns", "columns to encode; empty = all text", names)
    smoothing = param("smoothing", "rows' worth of global mean mixed in", number(0, open_low=True))
    DEFAULTS = {"columns": [], "smoothing": 1.0}

    def _fit(self, df: DataFrame) -> TargetEncoderModel:
        label = self.label(df)
        columns = self.chosen_or_text(df)
        if isinstance(df.schema[label].dataType, T.NumericType):
            target = col(label).cast("double")
        else:
            target = class_index(col(label), [c for c, _ in class_counts(df, label)])
        if not columns:
            return self.model(TargetEncoderModel, columns=[], overall=None)
        values = value_table(
            df, _as_text(columns), {"y": target}, n_y=F.count("y"), sum_y=F.sum("y")
        )
        # every row is in exactly one group of the first column, null group included
        seen = values.table.filter(F.col("column") == columns[0]).agg(F.sum("n_y"), F.sum("sum_y")).first()
        overall = seen[1] / seen[0] if seen[0] else None
        model = self.model(TargetEncoderModel, columns=columns, overall=overall)
        s = F.lit(self.get("smoothing"))
        shrunk = (F.coalesce("sum_y", F.lit(0.0)) + s * F.lit(overall).cast("double")) / (F.col("n_y") + s)
        return model.remember(values, values.table.withColumn("code", shrunk))


class TargetEncoderModel(EncoderModel):
    def _transform(self, df: DataFrame) -> DataFrame:
        if not self.learned["columns"]:
            return df
        overall = F.lit(self.learned["overall"]).cast("double")
        return self.placed(df, self.coded(df, overall, overall), {c: c for c in self.learned["columns"]})


class FrequencyEncoder(Configured, Estimator, Persisted):
    """Add each category's share of all fitted rows; unseen and null get 0."""

    columns = param("columns", "columns to encode; empty = all text", names)
    output_suffix = param("output_suffix", "suffix of the added columns", text)
    DEFAULTS = {"columns": [], "output_suffix": "_freq"}

    def _fit(self, df: DataFrame) -> FrequencyEncoderModel:
        columns = self.chosen_or_text(df)
        model = self.model(FrequencyEncoderModel, columns=columns, suffix=self.get("output_suffix"))
        if not columns:
            return model
        values = value_table(df, _as_text(columns))
        share = F.col("n") / F.lit(float(values.total or 1))
        return model.remember(values, values.table.withColumn("code", share))


class FrequencyEncoderModel(EncoderModel):
    def _transform(self, df: DataFrame) -> DataFrame:
        if not self.learned["columns"]:
            return df
        zero = F.lit(0.0)
        suffix = self.learned["suffix"]
        return self.placed(df, self.coded(df, zero, zero), {c: c + suffix for c in self.learned["columns"]})
