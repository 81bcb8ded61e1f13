"""Which columns a step touches, and safe references to them."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextvars import copy_context
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MAX_CLASSES = 10_000


def col(name: str) -> Column:
    """Reference to a column whose name may hold dots or backticks."""
    return F.col("`" + name.replace("`", "``") + "`")


def _names(df: DataFrame, kinds: tuple[type, ...], exclude: Iterable[str | None]) -> list[str]:
    skip = set(exclude)
    return [f.name for f in df.schema.fields if isinstance(f.dataType, kinds) and f.name not in skip]


def numeric_columns(df: DataFrame, exclude: Iterable[str | None] = ()) -> list[str]:
    return _names(df, (T.NumericType,), exclude)


def text_columns(df: DataFrame, exclude: Iterable[str | None] = ()) -> list[str]:
    return _names(df, (T.StringType,), exclude)


def fractional_columns(df: DataFrame) -> list[str]:
    return _names(df, (T.FloatType, T.DoubleType), ())


def as_double(name: str) -> Column:
    """The column as double, with NaN read as missing."""
    x = col(name).cast("double")
    return F.when(~F.isnan(x), x)


def nan_to_null(df: DataFrame) -> DataFrame:
    """Keep one missing marker: NaN becomes null in every fractional column."""
    names = fractional_columns(df)
    if not names:
        return df
    return df.withColumns({c: F.when(~F.isnan(col(c)), col(c)) for c in names})


def chunks(items: Sequence[Any], size: int) -> Iterator[Sequence[Any]]:
    for start in range(0, len(items), size):
        yield items[start : start + size]


def in_parallel(spark: SparkSession, jobs: Sequence[Callable[[], Any]], at_once: int) -> list[Any]:
    """Run independent Spark jobs from a few driver threads; results in order."""
    if at_once <= 1 or len(jobs) <= 1:
        return [job() for job in jobs]
    inherit = inheritable_thread_target(spark)
    with ThreadPoolExecutor(at_once) as pool:
        return [f.result() for f in [pool.submit(copy_context().run, inherit(job)) for job in jobs]]


def class_counts(df: DataFrame, label: str) -> list[tuple[Any, int]]:
    """(class, rows) sorted by class; nulls left out.

    Labels are few by nature; a column with more than ``MAX_CLASSES`` values is
    refused before it could reach the driver.
    """
    rows = (
        df.filter(col(label).isNotNull())
        .groupBy(col(label).alias("label"))
        .count()
        .limit(MAX_CLASSES + 1)
        .collect()
    )
    if len(rows) > MAX_CLASSES:
        raise ValueError(f"'{label}' has more than {MAX_CLASSES} distinct values; not a class label")
    return sorted((r["label"], r["count"]) for r in rows)


def class_index(label: Column, classes: Sequence[Any]) -> Column:
    """Position of the label in the sorted classes, as double; null if unknown."""
    pairs = [F.lit(x) for i, c in enumerate(classes) for x in (c, float(i))]
    return F.try_element_at(F.create_map(*pairs), label)
