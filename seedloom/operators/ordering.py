"""A total order over partitions: numbers and running sums without a task that sees everything."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seedloom.plans.lineage import written


def running_sum(df: DataFrame, order: list[str], value: Column, name: str) -> DataFrame:
    """``df`` with ``name``: the sum of ``value`` over the rows before a row, in order of the columns ``order``.

    The sum is cut into ranges of the order: sums of ranges are carried over, so no task sees more than its range. The
    ranges are written once, with their numbers, so that both readers see the same ones. Rows that tie share a range and follow one
    another in any way. An empty table stays empty.
    """
    part = written(df.withColumn("__value", value).repartitionByRange(*map(F.col, order)).withColumn("__part", F.spark_partition_id()))
    totals = part.groupBy("__part").agg(F.sum("__value").alias("__sum"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)  # a row per range
    totals = totals.withColumn("__before", F.coalesce(F.sum("__sum").over(before), F.lit(0))).drop("__sum")
    inside = Window.partitionBy("__part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    running = part.withColumn("__inside", F.coalesce(F.sum("__value").over(inside), F.lit(0)))
    summed = running.join(F.broadcast(totals), "__part")  # one row per shuffle partition
    return summed.withColumn(name, F.col("__inside") + F.col("__before")).drop("__part", "__inside", "__before", "__value")


def numbered(df: DataFrame, order: list[str], name: str = "position") -> DataFrame:
    """``df`` with the rows' numbers from 1 in order of the columns ``order``."""
    return running_sum(df, order, F.lit(1), name).withColumn(name, F.col(name) + 1)
