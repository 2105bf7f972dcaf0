"""Run-time and folder-bucket helpers.

Log folders are cut in 5-minute buckets named ``yyyy-MM-dd/HH-mm``; an ingest
run reads the previous *closed* bucket (at 00:02 that is ``<yesterday>/23-55``).
The run time is always a parameter so reruns are repeatable.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, functions as F

from strata.functions.text import _c

BUCKET_FORMAT = "yyyy-MM-dd/HH-mm"


def bucket_start(ts, width_seconds: int = 300, lag: int = 1) -> Column:
    """Start of the bucket ``lag`` widths before the one holding ``ts``.

    Arithmetic on the wall-clock value, so a ``timestamp_ntz`` column gives
    the same bucket whatever the session time zone. A null time has no bucket.
    """
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    micros = F.timestamp_diff("MICROSECOND", epoch, _c(ts).cast("timestamp_ntz"))
    seconds = micros - F.pmod(micros, F.lit(width_seconds * 1_000_000))
    return F.timestamp_add("SECOND", (seconds / 1_000_000).cast("long") - lag * width_seconds, epoch)


def bucket_path(ts, width_seconds: int = 300, lag: int = 1) -> Column:
    return F.date_format(bucket_start(ts, width_seconds, lag), BUCKET_FORMAT)


def bucket_folder(prefix: str, run_ts: _dt.datetime, width_seconds: int = 300) -> str:
    """``<prefix>/<yyyy-MM-dd>/<HH-mm>`` of the previous closed bucket."""
    epoch = int(run_ts.replace(tzinfo=_dt.timezone.utc).timestamp())
    start = _dt.datetime.fromtimestamp((epoch // width_seconds - 1) * width_seconds, _dt.timezone.utc)
    return f"{prefix.rstrip('/')}/{start:%Y-%m-%d}/{start:%H-%M}"


def bucket_glob(prefix: str, name: str, run_ts: _dt.datetime, width_seconds: int = 300,
                file_pattern: str | None = None) -> str:
    """``<prefix>/<yyyy-MM-dd>/<HH-mm>/<name>.*`` of the previous closed bucket."""
    return f"{bucket_folder(prefix, run_ts, width_seconds)}/{file_pattern or name + '.*'}"


def run_date(run_ts) -> Column:
    """Processing date stamped on every ingested row (``l_date``)."""
    if isinstance(run_ts, _dt.datetime):
        return F.lit(run_ts.strftime("%Y-%m-%d"))
    return F.date_format(_c(run_ts), "yyyy-MM-dd")


def days_before(day, n: int) -> Column:
    """``yyyy-MM-dd`` string ``n`` days before the ``yyyy-MM-dd`` column ``day``."""
    return F.date_format(F.date_sub(F.to_date(_c(day)), n), "yyyy-MM-dd")


def window_before(run_date: str, start_back: int, end_back: int) -> tuple[str, str]:
    """Inclusive ``(start, end)`` day strings ``start_back``..``end_back`` days
    before ``run_date`` (a run parameter, computed once on the driver)."""
    d = _dt.date.fromisoformat(run_date)
    a, b = d - _dt.timedelta(days=start_back), d - _dt.timedelta(days=end_back)
    return (min(a, b).isoformat(), max(a, b).isoformat())
