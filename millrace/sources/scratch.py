"""Tables written to the cluster's shared checkpoint folder.

Learned tables and reused intermediates are written once and read back, so that
their lineage ends there and a lost executor costs no refit.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from weakref import WeakKeyDictionary

from pyspark.sql import Column, DataFrame, SparkSession

#: Paths written in the innermost open scope.
_written: ContextVar[list[str] | None] = ContextVar("written", default=None)
#: Where ``write_table`` put the tables that it returned.
_paths: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()
#: Whether Spark removes a write's shuffle files as soon as it has ended.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def scratch_root(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir`` (own folder only in local mode)."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        configured = tempfile.mkdtemp(prefix="millrace-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Deletes at its end, also after a failure, the tables that ``write_table`` wrote in it (inner scopes have their own).

    For work whose result no longer reads them: scores, a fitted model held in memory, a saved one.
    """
    own: list[str] = []
    token = _written.set(own)
    try:
        yield
    finally:
        _written.reset(token)
        for path in own:
            _delete(spark, path)


def _delete(spark: SparkSession, path: str) -> None:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop_path, True)


def drop_tables(*tables: DataFrame) -> None:
    """Deletes tables that ``write_table`` returned, once nothing reads them any more; other tables stay."""
    for table in tables:
        if table in _paths:
            _delete(table.sparkSession, _paths.pop(table))


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Writes inside leave no shuffle files behind, which else stay until the driver happens to collect its garbage.

    A setting of the session: queries that other threads make meanwhile are treated alike.
    """
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


def write_table(df: DataFrame, **metrics: Column) -> tuple[DataFrame, dict]:
    """Write ``df`` once; return it read back, with the wanted aggregates of the written rows."""
    spark = df.sparkSession
    path = f"{scratch_root(spark)}/table-{uuid.uuid4().hex}"
    own = _written.get()
    if own is not None:
        own.append(path)
    df.write.parquet(path)
    written = spark.read.schema(df.schema).parquet(path)
    _paths[written] = path
    if not metrics:
        return written, {}
    return written, written.agg(*[m.alias(k) for k, m in metrics.items()]).first().asDict()
