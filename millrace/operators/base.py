"""Shared parts of the pipeline stages: parameters, learned state, persistence."""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

from pyspark.ml import Model
from pyspark.ml.param import Param, Params
from pyspark.ml.util import (
    DefaultParamsReadable,
    DefaultParamsReader,
    DefaultParamsWritable,
    DefaultParamsWriter,
    MLReadable,
    MLReader,
    MLWritable,
    MLWriter,
)
from pyspark.sql import DataFrame

from millrace.functions.columns import numeric_columns, text_columns
from millrace.functions.values import ValueTable


def one_of(*allowed: Any) -> Callable[[Any], Any]:
    def convert(value: Any) -> Any:
        if value not in allowed:
            raise ValueError(f"must be one of {allowed}, not {value!r}")
        return value

    return convert


def number(low: float | None = None, high: float | None = None, *, open_low: bool = False, whole: bool = False):
    """Converter for a bounded number; ``open_low`` excludes the lower bound."""

    def convert(value: Any) -> Any:
        if isinstance(value, bool) or not isinstance(value, (int, float)):
            raise TypeError(f"must be a number, not {value!r}")
        if whole and int(value) != value:
            raise ValueError(f"must be a whole number, not {value!r}")
        if low is not None and (value <= low if open_low else value < low):
            raise ValueError(f"must be {'above' if open_low else 'at least'} {low}, not {value!r}")
        if high is not None and value > high:
            raise ValueError(f"must be at most {high}, not {value!r}")
        return int(value) if whole else float(value)

    return convert


def optional(convert: Callable[[Any], Any]) -> Callable[[Any], Any]:
    return lambda value: None if value is None else convert(value)


def names(value: Any) -> list[str]:
    if isinstance(value, str) or not all(isinstance(v, str) for v in value):
        raise TypeError(f"must be a list of column names, not {value!r}")
    return list(value)


def text(value: Any) -> str:
    if not isinstance(value, str):
        raise TypeError(f"must be text, not {value!r}")
    return value


def param(name: str, doc: str, convert: Callable[[Any], Any]) -> Param:
    return Param(Params._dummy(), name, doc, convert)


class Configured(Params):
    """Keyword construction from plain parameters; unknown names are refused."""

    idCol = param("idCol", "row key, never treated as a feature", optional(text))
    labelCol = param("labelCol", "class label, never treated as a feature", optional(text))

    DEFAULTS: dict[str, Any] = {}

    def __init__(self, **params: Any) -> None:
        super().__init__()
        self._setDefault(idCol=None, labelCol=None, **self.DEFAULTS)
        unknown = set(params) - {p.name for p in self.params}
        if unknown:
            raise ValueError(f"{type(self).__name__}: unknown parameter {sorted(unknown)}")
        self._set(**params)

    def get(self, name: str) -> Any:
        return self.getOrDefault(name)

    @property
    def reserved(self) -> list[str]:
        return [c for c in (self.get("idCol"), self.get("labelCol")) if c]

    def numeric(self, df: DataFrame) -> list[str]:
        return numeric_columns(df, self.reserved)

    def chosen_or_numeric(self, df: DataFrame) -> list[str]:
        return self.get("columns") or self.numeric(df)

    def chosen_or_text(self, df: DataFrame) -> list[str]:
        return self.get("columns") or text_columns(df, self.reserved)

    def label(self, df: DataFrame) -> str:
        name = self.get("labelCol")
        if name is None or name not in df.columns:
            raise ValueError(f"{type(self).__name__} needs a label column; labelCol={name!r} is not in the data")
        return name

    def model(self, cls: type, **state: Any):
        """The fitted counterpart, with this stage's id and label columns."""
        return cls(idCol=self.get("idCol"), labelCol=self.get("labelCol"), state=state)


class Persisted(DefaultParamsReadable, DefaultParamsWritable):
    """Stages whose parameters are all they need to be saved."""


class Fitted(Configured, Model):
    """A fitted stage; ``state`` holds what it learned, in JSON types."""

    state = param("state", "learned values", dict)

    @property
    def learned(self) -> dict[str, Any]:
        return self.get("state")


class TableWriter(MLWriter):
    """Parameters as metadata, learned values as Parquet."""

    def __init__(self, instance: TableFitted) -> None:
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        values = self.instance.values
        size = None if values is None else [values.rows, values.n_bytes, values.total]
        DefaultParamsWriter.saveMetadata(self.instance, path, self.sparkSession, extraMetadata={"size": size})
        if values is not None:
            values.table.write.parquet(f"{path}/values")


class TableReader(MLReader):
    def __init__(self, cls: type) -> None:
        super().__init__()
        self.cls = cls

    def load(self, path: str) -> TableFitted:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        stage = self.cls()
        stage._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(stage, metadata)
        if metadata["size"] is not None:
            stage.values = ValueTable(self.sparkSession.read.parquet(f"{path}/values"), *metadata["size"])
        return stage


class TableFitted(Fitted, MLWritable, MLReadable):
    """A fitted stage that may also hold a written table of learned values."""

    values: ValueTable | None = None

    def write(self) -> TableWriter:
        return TableWriter(self)

    @classmethod
    def read(cls) -> TableReader:
        return TableReader(cls)
