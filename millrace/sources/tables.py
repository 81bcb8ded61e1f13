"""Reading feature and label tables and bringing them together by id."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.columns import chunks, col, nan_to_null

log = logging.getLogger(__name__)

# Cell texts read as missing in CSV files.
MISSING_TEXTS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]
WHOLE_PATTERN = r"^\s*[+-]?\d+\s*$"
DECIMAL_PATTERN = r"^\s*[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|[iI][nN][fF]([iI][nN][iI][tT][yY])?)\s*$"
BOOLEAN_PATTERN = r"^(true|True|TRUE|false|False|FALSE)$"
COLUMNS_PER_JOB = 100
LISTED_IDS = 20



def read_table(
    spark: SparkSession,
    path: str,
    *,
    fmt: str | None = None,
    schema: T.StructType | str | None = None,
    multi_line: bool = False,
) -> DataFrame:
    """A Parquet table, or a CSV table with a header; NaN and missing texts become null.

    A CSV without a given schema is typed by one pass over its cells: whole numbers, then
    decimal numbers, then true/false without gaps, else text. A record with more or fewer cells than
    the header is an error. Quoted line breaks need ``multi_line``, which reads a file in one task.
    """
    kind = fmt or ("csv" if path.lower().rstrip("/").endswith((".csv", ".csv.gz")) else "parquet")
    if kind == "parquet":
        return nan_to_null(spark.read.parquet(path))
    if kind != "csv":
        raise ValueError(f"format must be 'csv' or 'parquet', not {kind!r}")
    raw = (
        spark.read.option("columnPruning", False)  # else cells that no one asks for are not counted
        .csv(path, header=True, quote='"', escape='"', inferSchema=False, nullValue="", mode="FAILFAST", multiLine=multi_line)
    )
    texts = raw.select(*[F.when(~col(c).isin(MISSING_TEXTS), col(c)).alias(c) for c in raw.columns])
    if schema is not None:
        wanted = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
        return nan_to_null(texts.select(*[col(f.name).cast(f.dataType).alias(f.name) for f in wanted.fields]))
    return _typed(texts)


def _typed(texts: DataFrame) -> DataFrame:
    kinds: dict[str, str] = {}
    for part in chunks(texts.columns, COLUMNS_PER_JOB):
        exprs = []
        for i, c in enumerate(part):
            exprs += [
                F.count(col(c)).alias(f"n{i}"),
                F.bool_and(col(c).rlike(WHOLE_PATTERN)).alias(f"whole{i}"),
                F.count(F.trim(col(c)).try_cast("bigint")).alias(f"fits{i}"),
                F.bool_and(col(c).rlike(DECIMAL_PATTERN)).alias(f"decimal{i}"),
                F.bool_and(F.coalesce(col(c), F.lit("")).rlike(BOOLEAN_PATTERN)).alias(f"boolean{i}"),
            ]
        row = texts.agg(*exprs).first()
        for i, c in enumerate(part):
            if not row[f"n{i}"]:
                kinds[c] = "double"  # no value at all: a column of missing numbers
            elif row[f"whole{i}"] and row[f"fits{i}"] == row[f"n{i}"]:
                kinds[c] = "bigint"
            elif row[f"decimal{i}"]:
                kinds[c] = "double"
            elif row[f"boolean{i}"]:
                kinds[c] = "boolean"
            else:
                kinds[c] = "string"

    def cell(c: str):
        return col(c) if kinds[c] == "string" else F.trim(col(c)).cast(kinds[c])

    return texts.select(*[cell(c).alias(c) for c in texts.columns])


def read_features(spark: SparkSession, path: str, *, id_col: str = "id", **options) -> DataFrame:
    df = read_table(spark, path, **options)
    if id_col not in df.columns:
        raise ValueError(f"features have no id column '{id_col}'")
    return df


def read_labels(
    spark: SparkSession, path: str, *, id_col: str = "id", label_col: str | None = None, **options
) -> DataFrame:
    """The id and the one other column, renamed to ``label_col`` if given."""
    df = read_table(spark, path, **options)
    others = [c for c in df.columns if c != id_col]
    if id_col not in df.columns or len(others) != 1:
        raise ValueError(f"labels need '{id_col}' and exactly one other column, found {df.columns}")
    return df.select(col(id_col), col(others[0]).alias(label_col or others[0]))


def _id_sides(features: DataFrame, labels: DataFrame, id_col: str) -> DataFrame:
    """One row per id with its number of rows on either side (one shuffle of folded ids)."""
    left = features.select(col(id_col).alias("id"), F.lit(1).alias("f"), F.lit(0).alias("l"))
    right = labels.select(col(id_col).alias("id"), F.lit(0).alias("f"), F.lit(1).alias("l"))
    return left.unionByName(right).groupBy("id").agg(F.sum("f").alias("f"), F.sum("l").alias("l"))


def alignment_report(features: DataFrame, labels: DataFrame, id_col: str = "id") -> DataFrame:
    """One row: ids repeated on either side, ids on one side only, common ids."""
    return _id_sides(features, labels, id_col).agg(
        F.count_if(F.col("f") > 1).alias("features_repeated"),
        F.count_if(F.col("l") > 1).alias("labels_repeated"),
        F.count_if(F.col("l") == 0).alias("features_only"),
        F.count_if(F.col("f") == 0).alias("labels_only"),
        F.count_if((F.col("f") > 0) & (F.col("l") > 0)).alias("common"),
    )


def align(features: DataFrame, labels: DataFrame, id_col: str = "id") -> DataFrame:
    """Features and label of the ids found on both sides; ids must not repeat."""
    report = alignment_report(features, labels, id_col).first()
    for side, df in (("features", features), ("labels", labels)):
        if report[f"{side}_repeated"]:
            repeated = (
                df.groupBy(col(id_col).alias("id")).count().filter("count > 1").orderBy("id").limit(LISTED_IDS)
            )
            listed = [r["id"] for r in repeated.collect()]
            raise ValueError(f"Duplicate IDs in {side}: {listed} ({report[f'{side}_repeated']} in all)")
    for side, other in (("features", "labels"), ("labels", "features")):
        if report[f"{side}_only"]:
            log.warning("%d IDs in %s but not %s: dropped", report[f"{side}_only"], side, other)
    return features.join(labels, id_col, "inner")


def read_dataset(
    spark: SparkSession,
    features_path: str,
    labels_path: str,
    *,
    id_col: str = "id",
    label_col: str | None = None,
    **options,
) -> DataFrame:
    features = read_features(spark, features_path, id_col=id_col, **options)
    labels = read_labels(spark, labels_path, id_col=id_col, label_col=label_col, **options)
    return align(features, labels, id_col)
