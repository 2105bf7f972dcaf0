"""Segment job: stored rules -> active rules (R2) -> schema rewrite (P18) ->
fused counts (R1) -> result table or CSV (R3)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from strata.operators import segments
from strata.sinks.writers import export, replace_table

RESULT_COLUMNS = ("id", "group_number", "group_active_count")


def run_segment_job(facts: DataFrame, rules: DataFrame, start: str, end: str,
                    mapping: dict[str, str], exclude_names, target: str | None = None, fmt: str = "table",
                    files: int | None = None, user_col: str = "uuid", date_col: str = "l_date") -> DataFrame:
    """Count every active rule; write ``(id, group_number, group_active_count)``
    as strings (the stored layout) when ``target`` is given. Returns the result.
    ``mapping`` rewrites schema names; groups in ``exclude_names`` are not counted."""
    active = segments.normalize_rules(segments.active_rules(rules, exclude_names), mapping)
    counts = segments.segment_counts(facts, active, user_col=user_col, date_col=date_col,
                                     start=start, end=end)
    out = counts.select(*[F.col(c).cast("string").alias(c) for c in RESULT_COLUMNS])
    if target is not None:
        if fmt == "table":
            replace_table(out, target, files=files)
        else:
            export(out, target, fmt=fmt, mode="overwrite", files=files)
    return out
