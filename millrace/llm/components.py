"""Connected components of links that are already found, by hooking and jumping; nothing reaches the driver but counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.sources.scratch import drop_tables, write_table


def components(links: DataFrame) -> DataFrame:
    """node and label (the smallest node that it reaches) of every node in ``links`` (a, b).

    Each round every label takes its smallest neighbour's label, then that one's; links inside a
    label vanish, so the links shrink from round to round. Tables of a round are written, and deleted after it.
    """
    both = links.select("a", "b").where("a <> b")
    edges, n = write_table(both.distinct(), n=F.count(F.lit(1)))
    labels, _ = write_table(
        edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct().withColumn("label", F.col("node"))
    )
    while n["n"]:
        around = edges.union(edges.select("b", "a"))
        least = around.groupBy("a").agg(F.min("b").alias("b")).select("a", F.least("a", "b").alias("up"))
        hook, _ = write_table(least)
        top = hook.select(F.col("a").alias("up"), F.col("up").alias("top"))
        jump, _ = write_table(hook.join(top, "up").select("a", "top"))
        old = [edges, labels, hook, jump]
        labels, _ = write_table(
            labels.join(jump.withColumnRenamed("a", "label"), "label", "left").select(
                "node", F.coalesce("top", "label").alias("label")
            )
        )
        moved = edges.join(jump.withColumnRenamed("top", "a2"), "a").join(
            jump.select(F.col("a").alias("b"), F.col("top").alias("b2")), "b"
        )
        edges, n = write_table(
            moved.select(F.least("a2", "b2").alias("a"), F.greatest("a2", "b2").alias("b")).where("a <> b").distinct(),
            n=F.count(F.lit(1)),
        )
        drop_tables(*old)
    drop_tables(edges)
    return labels
