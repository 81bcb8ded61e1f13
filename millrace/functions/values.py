"""Tables with one row per (column, value), and looking rows up in them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import col
from millrace.sources.scratch import write_table

LITERAL_ROWS = 100
BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 32 * 1024 * 1024
HOT_SHARE = 1 / 256
SALTS = 64


@dataclass
class ValueTable:
    """A written table ``(column, value, n, ...)`` with its measured size."""

    table: DataFrame
    rows: int
    n_bytes: int
    total: int

    def with_table(self, table: DataFrame) -> ValueTable:
        return ValueTable(table, self.rows, self.n_bytes, self.total)


def long_form(df: DataFrame, columns: dict[str, Column], keep: dict[str, Column] | None = None) -> DataFrame:
    """One row per (input row, named expression): ``column``, ``value`` and the kept columns."""
    kept = keep or {}
    wide = df.select(*[x.alias(n) for n, x in kept.items()], *[x.alias(n) for n, x in columns.items()])
    return wide.unpivot([col(n) for n in kept], [col(n) for n in columns], "column", "value")


def value_table(
    df: DataFrame,
    columns: dict[str, Column],
    keep: dict[str, Column] | None = None,
    **aggregates: Column,
) -> ValueTable:
    """Count every value of every column in one pass and write the counts.

    Map-side aggregation folds each task's rows first, so a value that fills a third of
    the rows costs one shuffled row per task. Null is counted as a value of its own.
    """
    counted = (
        long_form(df, columns, keep)
        .groupBy("column", "value")
        .agg(F.count(F.lit(1)).alias("n"), *[a.alias(k) for k, a in aggregates.items()])
    )
    one = next(iter(columns))
    size = F.octet_length(F.col("value").cast("string")) + F.lit(48)
    table, seen = write_table(
        counted,
        rows=F.count(F.lit(1)),
        n_bytes=F.coalesce(F.sum(size), F.lit(0)),
        total=F.coalesce(F.sum(F.when(F.col("column") == one, F.col("n"))), F.lit(0)),
    )
    return ValueTable(table, seen["rows"], seen["n_bytes"], seen["total"])


def look_up(
    df: DataFrame,
    values: ValueTable,
    column: str,
    source: Column,
    codes: dict[str, Column],
    salt: Column,
) -> DataFrame:
    """Left-join the codes of ``source`` in ``column``'s part of the table.

    A part of proven small size is broadcast. A larger one is shuffled; the values that
    fill more than ``HOT_SHARE`` of the fitted rows (256 at most) are spread over salted
    copies, and so are missing values, so that no task receives a hot value whole.
    """
    part = values.table.filter((F.col("column") == column) & F.col("value").isNotNull())
    key = "__value"
    if values.rows <= BROADCAST_ROWS and values.n_bytes <= BROADCAST_BYTES:
        small = part.select(F.col("value").alias(key), *[c.alias(n) for n, c in codes.items()])
        joined = df.withColumn("__source", source)
        return joined.join(F.broadcast(small), F.col("__source") == F.col(key), "left").drop("__source", key)

    hot = F.col("n") >= F.lit(values.total * HOT_SHARE)
    hot_keys = part.filter(hot).select(F.col("value").alias("__hot"))
    salted = part.select(
        F.col("value").alias(key),
        *[c.alias(n) for n, c in codes.items()],
        F.explode(
            F.when(hot, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
        ).alias("__copy"),
    )
    spread = F.pmod(F.xxhash64(salt), F.lit(SALTS)).cast("int")
    marked = (
        df.withColumn("__source", source)
        .join(F.broadcast(hot_keys), F.col("__source") == F.col("__hot"), "left")
        .withColumn(
            "__salt",
            F.when(F.col("__hot").isNotNull() | F.col("__source").isNull(), spread).otherwise(F.lit(0)),
        )
    )
    on = (F.col("__source") == F.col(key)) & (F.col("__salt") == F.col("__copy"))
    return marked.join(salted, on, "left").drop("__source", "__hot", "__salt", "__copy", key)


def row_salt(df: DataFrame, id_col: str | None) -> Column:
    """What a row's salt is drawn from: its id, else the whole row (never ``rand``)."""
    if id_col and id_col in df.columns:
        return col(id_col)
    hashable = [f.name for f in df.schema.fields if "map<" not in f.dataType.simpleString()]
    return F.struct(*[col(c) for c in hashable])
