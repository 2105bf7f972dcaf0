"""Log-ingest jobs (C1 page log, C2 event log).

bucket folder (S2) -> text scan packing small files (S1) -> parse (P2-P7)
-> append into the ``l_date``-partitioned table (K1). One stage, no shuffle.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from strata.functions.clock import BUCKET_FORMAT, bucket_folder, bucket_glob
from strata.operators.logs import EVENT_SPEC, PAGE_SPEC, LogSpec, parse_log
from strata.sinks.writers import append_partitioned
from strata.session import hadoop_path, target_exists
from strata.sources.logs import read_log_lines

# default file-name prefixes inside a bucket folder (``<prefix>.*``)
PAGE_FILE = "page-log"
EVENT_FILE = "event-log"


def ingest_log(spark: SparkSession, prefix: str, name: str, spec: LogSpec, target: str,
               run_ts: dt.datetime, file_pattern: str | None = None) -> DataFrame:
    """Parse the previous closed 5-minute bucket under ``prefix`` and append it.

    Files are ``<name>.*`` unless ``file_pattern`` says otherwise. Returns the
    parsed DataFrame (already written).
    """
    glob = bucket_glob(prefix, name, run_ts, file_pattern=file_pattern)
    lines = read_log_lines(spark, glob)
    parsed = parse_log(lines, spec, run_ts)
    append_partitioned(parsed, target, "l_date")
    return parsed


def ingest_page_log(spark: SparkSession, prefix: str, target: str, run_ts: dt.datetime,
                    file_pattern: str | None = None) -> DataFrame:
    return ingest_log(spark, prefix, PAGE_FILE, PAGE_SPEC, target, run_ts, file_pattern)


def ingest_event_log(spark: SparkSession, prefix: str, target: str, run_ts: dt.datetime,
                     file_pattern: str | None = None) -> DataFrame:
    return ingest_log(spark, prefix, EVENT_FILE, EVENT_SPEC, target, run_ts, file_pattern)


_BUCKET = r"(\d{4}-\d{2}-\d{2}/\d{2}-\d{2})"
_FOLDER = "[0-9]" * 4 + "-[0-9][0-9]-[0-9][0-9]/[0-9][0-9]-[0-9][0-9]"


def closed_buckets(spark: SparkSession, prefix: str, run_ts: dt.datetime, since: str = "") -> list[str]:
    """The ``yyyy-MM-dd/HH-mm`` folders under ``prefix`` that are closed at
    ``run_ts`` and not before ``since``: names only, 288 a day."""
    last = bucket_folder("", run_ts).lstrip("/")
    fs, pattern = hadoop_path(spark, f"{prefix.rstrip('/')}/{_FOLDER}")
    found = fs.globStatus(pattern) or []
    names = sorted("/".join(str(f.getPath()).rsplit("/", 2)[1:]) for f in found)
    return [n for n in names if since <= n <= last]


def committed_buckets(spark: SparkSession, ledger: str) -> DataFrame:
    """``(bucket, run_ts)`` of the buckets that are wholly in the table."""
    schema = "bucket string, run_ts string"
    return spark.read.schema(schema).parquet(ledger) if target_exists(spark, ledger) else spark.createDataFrame([], schema)


def ingest_pending(spark: SparkSession, prefix: str, name: str, spec: LogSpec, target: str, ledger: str,
                   run_ts: dt.datetime, file_pattern: str | None = None, since: str = "") -> list[str]:
    """Ingest all closed buckets that the ledger does not have: those of missed
    runs too, each once. Returns their names.

    All are parsed in one job. A bucket's rows replace the partition
    ``(l_date, bucket)`` of the path ``target``; ``l_date`` is the day on which
    the bucket closed, whatever the run, so a run that died after its write and
    before its line in the ledger is simply repeated. ``read_committed`` shows
    only buckets of the ledger. One run at a time. Files that come into a
    bucket after its run are not read; ``since`` bounds the listing.
    """
    done = {r.bucket for r in committed_buckets(spark, ledger).where(F.col("bucket") >= since).collect()}  # names, 288 a day
    pending = [b for b in closed_buckets(spark, prefix, run_ts, since) if b not in done]
    if not pending:
        return []
    files = file_pattern or name + ".*"
    globs = [f"{prefix.rstrip('/')}/{b}/{files}" for b in pending]
    present = [g for g in globs if len(hadoop_path(spark, g)[0].globStatus(hadoop_path(spark, g)[1]) or [])]
    if present:
        bucket = F.regexp_extract("_metadata.file_path", _BUCKET + "/[^/]*$", 1)
        lines = read_log_lines(spark, present).select("value", bucket.alias("bucket"))
        closed = F.timestamp_add("MINUTE", F.lit(5), F.to_timestamp_ntz("bucket", F.lit(BUCKET_FORMAT)))
        parsed = parse_log(lines, spec, closed, keep=("bucket",))
        (parsed.withColumn("bucket", F.replace("bucket", F.lit("/"), F.lit("_"))).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("l_date", "bucket").parquet(target))
    entries = spark.createDataFrame([(b, run_ts.isoformat()) for b in pending], "bucket string, run_ts string")
    entries.coalesce(1).write.mode("append").parquet(ledger)
    return pending


def read_committed(spark: SparkSession, target: str, ledger: str, spec: LogSpec) -> DataFrame:
    """The ingested rows of the buckets in the ledger, with ``bucket`` last."""
    schema = ", ".join(f"{c} string" for c in (*spec.columns, "l_date", "bucket"))
    if not target_exists(spark, target):
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(schema).parquet(target)
    done = committed_buckets(spark, ledger).select(F.replace("bucket", F.lit("/"), F.lit("_")).alias("bucket")).distinct()
    return rows.join(done, "bucket", "left_semi").select(*rows.columns)
