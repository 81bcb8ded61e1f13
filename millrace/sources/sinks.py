"""Writing split tables, predictions and profile reports."""

from __future__ import annotations

from pyspark.sql import DataFrame

from millrace.functions.columns import col


def write(df: DataFrame, path: str, fmt: str = "parquet") -> str:
    if fmt == "csv":
        # white space at the ends of a text belongs to it
        df.write.mode("overwrite").csv(
            path, header=True, quote='"', escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
        )
    elif fmt == "parquet":
        df.write.mode("overwrite").parquet(path)
    else:
        raise ValueError(f"format must be 'csv' or 'parquet', not {fmt!r}")
    return path


def write_split(
    train: DataFrame, test: DataFrame, output_dir: str, *, id_col: str, label_col: str, fmt: str = "parquet"
) -> dict[str, str]:
    """Four folders: values and labels of the train and the test rows."""
    out = {}
    for side, df in (("train", train), ("test", test)):
        out[f"{side}_values"] = write(df.drop(label_col), f"{output_dir}/{side}_values", fmt)
        out[f"{side}_labels"] = write(df.select(col(id_col), col(label_col)), f"{output_dir}/{side}_labels", fmt)
    return out


def prediction_frame(scored: DataFrame, *, id_col: str = "id", output_col: str = "status_group") -> DataFrame:
    return scored.select(col(id_col), col("prediction").alias(output_col))


def write_predictions(
    scored: DataFrame,
    path: str,
    *,
    id_col: str = "id",
    output_col: str = "status_group",
    fmt: str = "csv",
    sort: bool = False,
) -> str:
    """id and predicted class of every row; sorted by id only on request."""
    frame = prediction_frame(scored, id_col=id_col, output_col=output_col)
    return write(frame.orderBy(col(id_col)) if sort else frame, path, fmt)


def write_reports(reports: dict[str, DataFrame], output_dir: str, prefix: str, fmt: str = "csv") -> dict[str, str]:
    """One folder per report, named ``{prefix}_{report}``."""
    return {name: write(df, f"{output_dir}/{prefix}_{name}", fmt) for name, df in reports.items()}
