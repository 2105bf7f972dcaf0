"""The daily listing/client match job, and C4 (best client per listing).

intents + listings -> normalise (P9-P11, P16, P19) -> today's counters (M1)
-> drop capped clients (J4) -> capped assignment (J1, J2, T1, M2) -> latest
intent row per pair (W2) -> replace the result table (K2) and the counter
table, stamped with today's date (A6).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from strata.operators import matching
from strata.operators.assignment import assign_capped
from strata.operators.counters import load_counts
from strata.session import target_exists
from strata.sinks.writers import commit_tables, read_committed_table, replace_table

# Result layout of the match table.
RESULT_COLUMNS = ("city_code", "share_id", "fh_id", "share_worker_id", "insert_worker_id", "cid",
                  "objective", "area_code", "area_name", "price_start", "price_end", "house_type",
                  "house_area_start", "house_area_end", "purpose_school", "purpose_school_id",
                  "purpose_school_name")


def run_match(houses: DataFrame, intents: DataFrame, state: DataFrame | None, run_date: str,
              k: int = 3, cap: int = 3, min_clients: int = 3) -> tuple[DataFrame, DataFrame, int]:
    """Return ``(result, new_state, turns)``; ``state`` is ``(cid, count, p_date)``."""
    h = matching.identified(matching.normalize_houses(houses))
    i = matching.normalize_intents(intents)
    counts = load_counts(state, run_date) if state is not None else None
    picks, new_counts, turns = assign_capped(h, i, counts, k=k, cap=cap, min_clients=min_clients)
    result = matching.match_result(picks, h, i).select(
        *RESULT_COLUMNS, "rid", "see_time", "update_time", "n_rows", "rank", "tier")
    return result, new_counts.withColumn("p_date", F.lit(run_date)), turns


def run_match_job(spark: SparkSession, houses: DataFrame, intents: DataFrame, state_target: str,
                  result_target: str, run_date: str, files: int | None = None, **kw) -> int:
    """Run C3 and replace both tables. The new counters are checkpointed, so
    overwriting the state table they were computed from is safe. ``files``
    fixes the output file count (1 = a single file); by default AQE sizes
    the files."""
    state = None
    if target_exists(spark, state_target):  # else it is the first run; an unreadable state raises
        state = spark.read.parquet(state_target) if "/" in state_target else spark.table(state_target)
    result, new_state, turns = run_match(houses, intents, state, run_date, **kw)
    replace_table(result.select(*RESULT_COLUMNS), result_target, files=files)
    replace_table(new_state, state_target, files=files)
    return turns


def run_match_commit(spark: SparkSession, houses: DataFrame, intents: DataFrame, root: str, run_date: str, **kw) -> str:
    """Run C3 with result and counters as one commit under ``root`` (tables
    ``result`` and ``state``): a run that fails between the two changes
    neither, and its repetition starts from the last complete run's counters.
    Returns the run's id."""
    state = read_committed_table(spark, root, "state")
    result, new_state, _ = run_match(houses, intents, state, run_date, **kw)
    return commit_tables(spark, root, {"result": result.select(*RESULT_COLUMNS), "state": new_state})


def run_best_client_job(houses: DataFrame, intents: DataFrame, result_target: str,
                        files: int | None = None) -> DataFrame:
    """C4: the older rule's single best client per listing, written as a table."""
    h = matching.normalize_houses(houses)
    i = matching.normalize_intents(intents)
    best = matching.best_client_per_house(h, i)
    replace_table(best, result_target, files=files)
    return best
