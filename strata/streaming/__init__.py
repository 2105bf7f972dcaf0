"""Structured Streaming ingest of the same log parsers."""

from strata.streaming.ingest import stream_log  # noqa: F401
