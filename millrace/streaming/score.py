"""Predicting the files of a folder as they arrive.

Fitted stages start no job in ``transform``, so a stored pipeline applies to a stream of
feature rows as it does to a table.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from millrace.functions.columns import nan_to_null
from millrace.sources.sinks import prediction_frame


def predict_arriving(
    spark: SparkSession,
    fitted: PipelineModel,
    folder: str,
    schema: T.StructType,
    output: str,
    checkpoint: str,
    *,
    id_col: str = "id",
    output_col: str = "status_group",
) -> StreamingQuery:
    """Score every Parquet file not scored before, then stop."""
    rows = nan_to_null(spark.readStream.schema(schema).parquet(folder))
    scored = prediction_frame(fitted.transform(rows), id_col=id_col, output_col=output_col)
    return (
        scored.writeStream.format("parquet")
        .option("path", output)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
