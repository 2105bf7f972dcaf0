"""Small operators: id lists, null fill, date-partition scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from strata.operators.running import running_totals


def collect_ids(df: DataFrame, key: str, value: str, drop_null: bool = True,
                out: str = "ids") -> DataFrame:
    """A2: the values of each key as a sorted list (stable across runs)."""
    src = df.where(F.col(value).isNotNull()) if drop_null else df
    return src.groupBy(key).agg(F.sort_array(F.collect_list(value)).alias(out))


def collect_id_chunks(df: DataFrame, key: str, value: str, size: int = 10_000) -> DataFrame:
    """A2 for keys of any size: each key's values in ascending order, cut into
    lists of ``size``: ``(key, chunk, n, ids)``, chunks numbered from 0.

    Rows are range-partitioned by (key, value) and numbered by running counts,
    so a hot key is spread over tasks and no list outgrows ``size``. Null
    values are left out; null is a key like any other; repeated values all
    stay. Of one key, equal values share a partition.
    """
    rows = df.where(F.col(value).isNotNull()).select(F.struct(F.col(key).alias("key")).alias("_key"), F.col(value).alias("_value_of"))
    placed = running_totals(rows, ["_key"], [F.col("_value_of")], F.lit(1), "id-places", "_place")
    return (placed.groupBy("_key", F.expr(f"(_place - 1) div {size}").alias("chunk"))
            .agg(F.count(F.lit(1)).alias("n"), F.sort_array(F.collect_list("_value_of")).alias("ids"))
            .select(F.col("_key.key").alias(key), "chunk", "n", "ids"))


def fill_defaults(df: DataFrame, number: float = 0.0, text: str = " ") -> DataFrame:
    """Nulls in numeric columns become ``number``, in string columns ``text``."""
    nums = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
    strs = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    out = df
    if nums:
        out = out.na.fill(number, subset=nums)
    if strs:
        out = out.na.fill(text, subset=strs)
    return out


def date_partition_scan(df: DataFrame, date_col: str, start: str | None = None,
                        end: str | None = None, on: str | None = None) -> DataFrame:
    """Rows of a date-partitioned table by partition predicate (pruned by Catalyst)."""
    c = F.col(date_col)
    cond = F.lit(True)
    if on is not None:
        cond = cond & (c == on)
    if start is not None:
        cond = cond & (c >= start)
    if end is not None:
        cond = cond & (c <= end)
    return df.where(cond)
