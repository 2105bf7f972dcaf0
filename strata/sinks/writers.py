"""Writers. File counts are left to AQE unless a caller asks for a number.

A target is a catalog table name, or a path when it contains ``/``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from strata.session import hadoop_path


def _is_path(target: str) -> bool:
    return "/" in target or target.startswith("file:")


def append_partitioned(df: DataFrame, target: str, partition_col: str = "l_date") -> None:
    """Append rows; the partition value is taken from each row (dynamic).

    For an existing catalog table ``insertInto`` is positional, so columns are
    put in the table's order first.
    """
    spark = df.sparkSession
    if not _is_path(target) and spark.catalog.tableExists(target):
        cols = spark.table(target).columns
        df.select(*cols).write.mode("append").insertInto(target)
        return
    w = df.write.mode("append").partitionBy(partition_col)
    if _is_path(target):
        w.parquet(target)
    else:
        w.saveAsTable(target)


def replace_table(df: DataFrame, target: str, files: int | None = None) -> None:
    """Replace a whole table. Do not point ``target`` at a table ``df`` reads."""
    out = df.repartition(files) if files else df
    if _is_path(target):
        out.write.mode("overwrite").parquet(target)
    else:
        out.write.mode("overwrite").saveAsTable(target)


def commit_tables(spark: SparkSession, root: str, tables: dict[str, DataFrame]) -> str:
    """K2 for tables that belong together: all are written into a folder of
    their own under ``root``, then one empty file, numbered, makes them the
    current ones at once. Returns the run's id.

    A run that dies before that file leaves the last complete run in place;
    ``read_committed_table`` never shows its part. Earlier runs stay until they
    are deleted, so tables may be computed from the ones they replace. One
    writer at a time: a second one with the same number fails.
    """
    run = uuid.uuid4().hex[:12]
    for name, df in tables.items():
        df.write.mode("errorifexists").parquet(f"{root.rstrip('/')}/runs/{run}/{name}")
    done = _commits(spark, root)
    fs, path = hadoop_path(spark, f"{root.rstrip('/')}/commits/{len(done):010d}-{run}")
    taken, clash = hadoop_path(spark, f"{root.rstrip('/')}/commits/{len(done):010d}-*")
    if taken.globStatus(clash):
        raise RuntimeError(f"another run was committed to {root} meanwhile")
    if not fs.createNewFile(path):
        raise RuntimeError(f"could not commit run {run} to {root}")
    return run


def _commits(spark: SparkSession, root: str) -> list[str]:
    """The names of the commit files in order, one per complete run."""
    fs, pattern = hadoop_path(spark, f"{root.rstrip('/')}/commits/*-*")
    return sorted(str(f.getPath()).rsplit("/", 1)[1] for f in fs.globStatus(pattern) or [])


def read_committed_table(spark: SparkSession, root: str, name: str) -> DataFrame | None:
    """A table of the last complete run under ``root``; None before the first."""
    done = _commits(spark, root)
    if not done:
        return None
    return spark.read.parquet(f"{root.rstrip('/')}/runs/{done[-1].split('-', 1)[1]}/{name}")


def snapshot_table(df: DataFrame, target: str, files: int | None = None) -> None:
    """Write a new table; fail if it exists. ``files`` sets the file count."""
    out = df.repartition(files) if files else df
    if _is_path(target):
        out.write.mode("errorifexists").parquet(target)
    else:
        out.write.mode("errorifexists").saveAsTable(target)


def export(df: DataFrame, path: str, fmt: str = "csv", mode: str = "errorifexists",
           files: int | None = None, header: bool = False) -> None:
    """CSV / JSON / text export, one file per task. ``files`` asks for a number
    of files, for small results only: 1 sends all rows through one task."""
    out = df.repartition(files) if files else df
    w = out.write.mode(mode)
    if fmt == "csv":
        w.option("header", str(header).lower()).csv(path)
    elif fmt == "json":
        w.json(path)
    elif fmt == "text":
        w.text(path)
    elif fmt == "parquet":
        w.parquet(path)
    else:
        raise ValueError(f"unknown format {fmt}")
