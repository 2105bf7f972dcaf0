"""Per-client match counters kept between runs (a small state table).

The state table is ``(cid, count, p_date)``. Counters are per day: rows
stamped with another day read as empty, so the daily reset is a filter and
needs no separate bookkeeping write.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def load_counts(state: DataFrame, run_date: str) -> DataFrame:
    """M1: the counters valid on ``run_date`` (others are from an earlier day)."""
    return state.where(F.col("p_date") == F.lit(run_date)).select(
        "cid", F.col("count").cast("long").alias("count"))


def load_counts_with_day(counts: DataFrame, day: DataFrame, run_date: str) -> DataFrame:
    """M1, two-table layout: ``counts(cid, count)`` are valid only when the
    stored ``day(p_date)`` (its latest value) equals ``run_date``."""
    stored = day.agg(F.max("p_date")).scalar()
    return counts.where(F.lit(run_date) == stored).select(
        "cid", F.col("count").cast("long").alias("count"))


def merge_counts(state: DataFrame, delta: DataFrame, run_date: str | None = None) -> DataFrame:
    """Add ``delta(cid, n)`` to ``state(cid, count)``. One aggregation of
    both, so a null client is a client like any other."""
    both = (state.select("cid", F.col("count").cast("long").alias("n"))
            .unionByName(delta.select("cid", F.col("n").cast("long").alias("n"))))
    out = both.groupBy("cid").agg(F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("count"))
    if run_date is not None:
        out = out.withColumn("p_date", F.lit(run_date))
    return out


def capped_clients(counts: DataFrame, cap: int = 3) -> DataFrame:
    """Clients out of the pool: ``count > cap`` (a client may be matched cap+1 times)."""
    return counts.where(F.col("count") > cap).select("cid")


def exclude_capped(intents: DataFrame, counts: DataFrame, cap: int = 3) -> DataFrame:
    """Drop intents of capped clients (null-safe left anti join on ``cid``)."""
    capped = capped_clients(counts, cap).select(F.col("cid").alias("_capped"))
    return intents.join(capped, F.col("cid").eqNullSafe(F.col("_capped")), "left_anti")
