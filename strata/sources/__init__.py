"""Sources: log folders, catalog tables, JSON, and bindings onto the test tables."""

from strata.sources.logs import read_log_lines, read_json  # noqa: F401
