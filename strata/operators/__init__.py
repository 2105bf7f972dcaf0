"""DataFrame operators: log parsing, matching, counters, capped assignment, segments."""
