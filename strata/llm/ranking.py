"""Positions and running totals in a global order, by range partitions.

Rows are range-partitioned by the whole order, so partitions are even whatever
the keys: the order should end in a column that tells equal rows apart. Sums
per partition (and group) give offsets; only rows of one partition are ordered
against each other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from strata.llm.common import saved

#: spark_partition_id of a number of monotonically_increasing_id
_ROW_BITS = 33


def numbered(df: DataFrame, order: list[Column], name: str, position: str = "pos") -> DataFrame:
    """``df`` with consecutive positions from 0 in the given order."""
    rows = saved(df.repartitionByRange(*order).sortWithinPartitions(*order)
                 .withColumn("_at", F.monotonically_increasing_id()), name)
    part = F.shiftright("_at", _ROW_BITS).alias("_part")
    offsets = _offsets(rows.groupBy(part).agg(F.count(F.lit(1)).alias("_sum")), [])
    return (rows.withColumn("_part", part).join(offsets, "_part")
            .withColumn(position, F.col("_offset") + F.col("_at").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)))
            .drop("_part", "_offset", "_at"))


def range_partitioned(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """``df`` range-partitioned and written; ``part`` numbers the ranges."""
    return saved(df.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), name)


def running_totals(df: DataFrame, group: str, order: list[str], value: str, name: str, total: str = "total") -> DataFrame:
    """``df`` with the running total of ``value`` inside each group, own row
    included. A group of any size is spread over ranges of (group, order)."""
    rows = range_partitioned(df, [F.col(c) for c in (group, *order)], name)
    sums = rows.groupBy("part", group).agg(F.sum(value).alias("_sum")).withColumnRenamed("part", "_part")
    offsets = _offsets(sums, [group])
    inside = Window.partitionBy("part", group).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("_inside", F.sum(value).over(inside))
    return (rows.join(offsets.withColumnsRenamed({"_part": "part"}), ["part", group])
            .withColumn(total, F.col("_offset") + F.col("_inside")).drop("_offset", "_inside", "part"))


def _offsets(sums: DataFrame, group: list[str]) -> DataFrame:
    """Sums of all earlier partitions; a group has one row for each partition
    that it reaches."""
    before = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    return sums.select(*group, "_part", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_offset"))
