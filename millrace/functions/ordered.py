"""Running totals in value order, over tables too long for one sorted task."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.sources.scratch import write_table

ROWS_PER_BUCKET = 500_000


def running_total(
    table: DataFrame,
    rows: int,
    group: str,
    order: str,
    weight: Column,
    out: str,
    *,
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """Add ``out``: the sum of ``weight`` over earlier rows of the group, own row excluded.

    ``table`` holds one row per (group, order) and ``rows`` rows in all. A short table is
    one window per group. A longer one is range-partitioned once into buckets of bounded
    size, whatever the groups: each bucket is summed on its own, and the few bucket totals
    carry the sums over.
    """
    before = Window.partitionBy(group, "bucket").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum(weight).over(before), F.lit(0))
    n_buckets = math.ceil(rows / rows_per_bucket)
    if n_buckets <= 1:
        return table.withColumn("bucket", F.lit(0)).withColumn(out, inside).drop("bucket")

    ranged = table.repartitionByRange(n_buckets, group, order).withColumn("bucket", F.spark_partition_id())
    ranged, _ = write_table(ranged)
    earlier = Window.partitionBy(group).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    totals = (
        ranged.groupBy(group, "bucket")
        .agg(F.sum(weight).alias("total"))
        .withColumn("carried", F.coalesce(F.sum("total").over(earlier), F.lit(0)))
        .drop("total")
    )
    # at most (groups + buckets) rows
    return (
        ranged.withColumn(out, inside)
        .join(F.broadcast(totals), [group, "bucket"])
        .withColumn(out, F.col(out) + F.col("carried"))
        .drop("bucket", "carried")
    )
