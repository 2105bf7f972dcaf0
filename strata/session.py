"""Session and shared-folder helpers.

Cluster deployments bring their own SparkSession; these helpers only fill in
defaults when a value is unset, so a cluster's configuration always wins.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Defaults for a session this library creates itself (tests, bench). On a
# cluster the submitter's settings take precedence.
_DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # checkpoint files of iterative jobs are removed once nothing references them
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_session(master: str | None = None, app: str = "strata",
                shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    """Return the active session, or build one with sensible defaults."""
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in _DEFAULTS.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in conf.items():
        builder = builder.config(k.replace("__", "."), v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster the setting must be present (a machine-local folder would not
    survive executor loss). Only a local session gets a temporary folder.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d:
        if not _is_local(spark):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        d = tempfile.mkdtemp(prefix="strata-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder, for written tables.

    The folder's URI is kept whole, so a table lands on the file system that
    the setting names whatever the cluster's default file system is. The path
    is deleted when the driver ends."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/strata-{name}-{uuid.uuid4().hex[:12]}"
    hadoop_path(spark, path)[0].deleteOnExit(hadoop_path(spark, path)[1])
    return path


def hadoop_path(spark: SparkSession, path: str):
    """(file system, path) of a path, by Spark's Hadoop configuration."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def target_exists(spark: SparkSession, target: str) -> bool:
    """Whether a catalog table, or a path (it contains ``/``), is there."""
    if "/" not in target:
        return spark.catalog.tableExists(target)
    fs, p = hadoop_path(spark, target)
    return fs.exists(p)


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str):
    return spark.read.parquet(table_path(sf_dir, name))
