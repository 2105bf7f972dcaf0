"""Positions and running totals of groups of any size.

Rows are range-partitioned by (group, order), so a hot group is spread over
many tasks. Sums for each partition and group give offsets, and only rows of
one partition are ordered against each other. The partitioned rows are
written, so that both passes see the same ranges and a lost executor repeats
one of them at most. Orders should tell rows apart: equal rows stay together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from strata.session import scratch_path


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def running_totals(df: DataFrame, group: list[str], order: list[Column], value: Column, name: str, total: str = "total") -> DataFrame:
    """``df`` with the running total of ``value`` in each group by ``order``,
    the own row included. Group columns must not be null."""
    rows = written(df.withColumn("_value", value).repartitionByRange(*[F.col(g) for g in group], *order)
                   .withColumn("_part", F.spark_partition_id()), name)
    sums = rows.groupBy("_part", *group).agg(F.sum("_value").alias("_sum"))
    before = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("_part", *group, F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy("_part", *group).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return (rows.withColumn("_inside", F.sum("_value").over(inside)).join(offsets, ["_part", *group])
            .withColumn(total, F.col("_offset") + F.col("_inside")).drop("_part", "_offset", "_inside", "_value"))


def numbered(df: DataFrame, order: list[Column], name: str, position: str) -> DataFrame:
    """``df`` with consecutive numbers from 0 in the given order."""
    one = running_totals(df.withColumn("_all", F.lit(0)), ["_all"], order, F.lit(1), name, "_n")
    return one.withColumn(position, F.col("_n") - 1).drop("_all", "_n")
