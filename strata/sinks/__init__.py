"""Sinks: partitioned append, table replace/snapshot, file exports."""

from strata.sinks.writers import append_partitioned, replace_table, snapshot_table, export  # noqa: F401
