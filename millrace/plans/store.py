"""Versioned folder of fitted pipelines: ``{name}_{YYYYMMDD_HHMMSS_ffffff}``, never overwritten.

A model is written to a staging folder and becomes visible by one rename, whole or not at all. The
rename refuses a name that is taken, so of two savers the later one gets the next microsecond's.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterator
from datetime import datetime, timedelta
from typing import Any

from py4j.protocol import Py4JJavaError
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The folder name format.
STAMP = "%Y%m%d_%H%M%S_%f"
STAMP_PATTERN = r"\d{8}_\d{6}_\d{6}"
#: Names that start so are no models; models on their way are in the first of them.
HIDDEN = ("_", ".")
STAGING = "_staging"


class _Folder:
    """A folder on any storage that Hadoop reaches."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.fs_package = spark._jvm.org.apache.hadoop.fs
        self.path, self.conf, self.gateway = path, spark._jsc.hadoopConfiguration(), spark.sparkContext._gateway
        self.system = self._at("").getFileSystem(self.conf)

    def _at(self, inside: str):
        return self.fs_package.Path(f"{self.path}/{inside}" if inside else self.path)

    def has(self, inside: str) -> bool:
        return self.system.exists(self._at(inside))

    def models(self) -> list[str]:
        """Names of the committed models."""
        if not self.has(""):
            return []
        found = [s.getPath().getName() for s in self.system.listStatus(self._at("")) if s.isDirectory()]
        return sorted(n for n in found if not n.startswith(HIDDEN))

    def delete(self, inside: str) -> None:
        self.system.delete(self._at(inside), True)

    def renamed(self, old: str, new: str) -> bool:
        """Whether ``old`` is now ``new``; False if that name is taken."""
        kind = getattr(self.fs_package, "Options$Rename")
        how = self.gateway.new_array(kind, 1)
        how[0] = kind.NONE
        here = self.fs_package.FileContext.getFileContext(self._at("").toUri(), self.conf)
        whole = self.system.makeQualified
        try:
            here.rename(whole(self._at(old)), whole(self._at(new)), how)
        except Py4JJavaError as e:
            if e.java_exception.getClass().getSimpleName() == "FileAlreadyExistsException":
                return False
            raise
        return True


def _moments() -> Iterator[datetime]:
    """Now, then every microsecond after it."""
    moment = datetime.now()
    while True:
        yield moment
        moment += timedelta(microseconds=1)


def save(
    spark: SparkSession, fitted: PipelineModel, name: str, models_dir: str, *, spec: dict[str, Any] | None = None
) -> str:
    """Save under a new stamped stem, with the spec if given; returns the stem."""
    folder, staged = _Folder(spark, models_dir), f"{STAGING}/{uuid.uuid4().hex}"
    try:
        fitted.write().save(f"{models_dir}/{staged}")
        if spec is not None:
            text = spark.createDataFrame([(json.dumps(spec),)], "value string")
            text.coalesce(1).write.text(f"{models_dir}/{staged}/spec")
        stems = (f"{name}_{moment.strftime(STAMP)}" for moment in _moments())
        return next(stem for stem in stems if folder.renamed(staged, stem))
    finally:
        folder.delete(staged)  # gone already unless something failed


def _model_path(spark: SparkSession, stem: str, models_dir: str) -> str:
    if stem not in _Folder(spark, models_dir).models():
        raise FileNotFoundError(f"no saved model at {models_dir}/{stem}")
    return f"{models_dir}/{stem}"


def load(spark: SparkSession, stem: str, models_dir: str) -> PipelineModel:
    return PipelineModel.load(_model_path(spark, stem, models_dir))


def load_spec(spark: SparkSession, stem: str, models_dir: str) -> dict[str, Any]:
    """The spec a stored model was built from."""
    path = f"{_model_path(spark, stem, models_dir)}/spec"
    if not _Folder(spark, path).has(""):
        raise FileNotFoundError(f"no spec was saved with {models_dir}/{stem}")
    return json.loads(spark.read.text(path).first()["value"])


def latest_stem(spark: SparkSession, name: str, models_dir: str) -> str:
    """Newest stem of exactly this name (a longer name with the same start does not count)."""
    own = re.compile(f"{re.escape(name)}_{STAMP_PATTERN}")
    newest = max(filter(own.fullmatch, _Folder(spark, models_dir).models()), default=None)
    if newest is None:
        raise FileNotFoundError(f"no saved model named '{name}' in {models_dir}")
    return newest


def load_latest(spark: SparkSession, name: str, models_dir: str) -> PipelineModel:
    return load(spark, latest_stem(spark, name, models_dir), models_dir)


def list_models(spark: SparkSession, models_dir: str) -> DataFrame:
    """stem, name, saved_at, path of every saved model; a folder without a stamp has its own name and no time."""
    stems = spark.createDataFrame([(s,) for s in _Folder(spark, models_dir).models()], "stem string")
    name, stamp = (F.regexp_extract("stem", f"^(.+)_({STAMP_PATTERN})$", i) for i in (1, 2))
    return stems.select(
        "stem",
        F.when(stamp == "", F.col("stem")).otherwise(name).alias("name"),
        F.try_to_timestamp(stamp, F.lit("yyyyMMdd_HHmmss_SSSSSS")).alias("saved_at"),
        F.concat(F.lit(f"{models_dir}/"), "stem").alias("path"),
    )
