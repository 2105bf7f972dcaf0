"""Helpers that the operators share."""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from strata.session import hadoop_path, scratch_path

#: bytes of an Arrow batch
BATCH = 4 << 20


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the given folder, by Spark's own reader."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def saved(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: a cut of the
    lineage that outlives executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.scratch = path
    return out


def discard(*tables: DataFrame) -> None:
    """Deletes tables of ``saved`` whose last reader has been written, and lets
    the driver forget the shuffles and broadcasts behind them, so that their
    files go too."""
    for t in tables:
        fs, path = hadoop_path(t.sparkSession, t.scratch)
        fs.delete(path, True)
    gc.collect()
    tables[0].sparkSession._jvm.System.gc()


def short_batches(spark: SparkSession) -> None:
    """Arrow batches of whole texts end at ``BATCH`` bytes, unless the session
    has a bound of its own: rows alone (10,000) let executor, socket and worker
    hold tens of MB of each task several times over."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key, None) is None:
        spark.conf.set(key, str(BATCH))


def others(docs: DataFrame, *taken: str):
    """A struct of all further columns, to pass through unread; None if there
    are none."""
    rest = [c for c in docs.columns if c not in taken]
    return F.struct(*[F.col(f"`{c}`") for c in rest]).alias("rest") if rest else None


def field(df: DataFrame, name: str, alias: str | None = None) -> str:
    """A column as text for a schema."""
    return f"`{alias or name}` {df.schema[name].dataType.simpleString()}"


Step = Callable[[pa.RecordBatch], Iterator[dict | pa.RecordBatch]]


def map_arrow(df: DataFrame, schema: str, fn: Step) -> DataFrame:
    """``fn`` over Arrow batches. It yields dicts of column values or Arrow
    arrays in the order of ``schema``."""
    return map_steps(df, [(schema, fn)])


def map_steps(df: DataFrame, steps: list[tuple[str, Step]]) -> DataFrame:
    """Functions of ``map_arrow``, each over what the one before yields. One
    worker runs them all; a ``map_arrow`` of another one has a worker for each."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    targets = [(to_arrow_schema(StructType.fromDDL(schema), prefers_large_types=False), fn) for schema, fn in steps]

    def stepped(batches, target, fn):
        for batch in batches:
            for out in fn(batch):
                if isinstance(out, dict):
                    arrays = [(v if v.type == f.type else v.cast(f.type)) if isinstance(v, (pa.Array, pa.ChunkedArray)) else pa.array(v, type=f.type)
                              for f, v in ((f, out[f.name]) for f in target)]
                    arrays = [a.combine_chunks() if isinstance(a, pa.ChunkedArray) else a for a in arrays]
                    out = pa.RecordBatch.from_arrays(arrays, schema=target)
                if out.num_rows:
                    yield out

    def run(batches):
        try:
            for target, fn in targets:
                batches = stepped(batches, target, fn)
            yield from batches
        finally:  # workers are used again: buffers of this task go back to the system
            pa.default_memory_pool().release_unused()

    return df.mapInArrow(run, steps[-1][0])
