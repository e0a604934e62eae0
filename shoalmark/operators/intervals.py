"""Ranges on a line: one sweep that tells which of them overlap, and where none is."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shoalmark.session import stage


def sweep(ranges: DataFrame, start: str, end: str, key: list[str]) -> DataFrame:
    """Add ``reach``, the largest end of all ranges before each (null for the first), and
    ``cluster``, which ranges share that overlap directly or through others.

    Ranges are half open and not empty; those with one start are ordered by larger end, then by
    ``key``, which must be unique. Rows are sorted by range into many tasks, each of which sweeps
    its own; what a task starts with is the largest end of the tasks before it, one row for each
    task. So no task sees all ranges.
    """
    in_order = [F.col(start), F.col(end).desc(), *map(F.col, key)]
    sliced = stage(ranges.repartitionByRange(*in_order).withColumn("__task", F.spark_partition_id()), "sweep")
    own = Window.partitionBy("__task").orderBy(*in_order)
    earlier = Window.orderBy("__task").rowsBetween(Window.unboundedPreceding, -1)
    ends = sliced.groupBy("__task").agg(F.max(end).alias("__end"))
    carried = ends.select("__task", F.max("__end").over(earlier).alias("__carried"))
    swept = sliced.join(F.broadcast(carried), "__task").withColumn(
        "reach", F.greatest(F.max(end).over(own.rowsBetween(Window.unboundedPreceding, -1)), "__carried"))
    opens = F.when(F.coalesce(F.col(start) >= F.col("reach"), F.lit(True)), F.col(start))
    swept = stage(swept.withColumn("__opens", opens), "swept")
    # A cluster is named by the start of the range that opens it, the last one up to a range.
    opened = swept.groupBy("__task").agg(F.max("__opens").alias("__last"))
    carried = opened.select("__task", F.max("__last").over(earlier).alias("__before"))
    cluster = F.greatest(F.max("__opens").over(own.rowsBetween(Window.unboundedPreceding, 0)), "__before")
    return (swept.drop("__carried").join(F.broadcast(carried), "__task").withColumn("cluster", cluster)
            .drop("__task", "__opens", "__before"))
