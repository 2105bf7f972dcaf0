"""Vectors summed over partitions."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame


def partition_sum(df: DataFrame, fn: Callable[[pa.RecordBatch], np.ndarray], length: int, fan_in: int = 8) -> np.ndarray:
    """The sum of ``fn`` (a vector of ``length`` doubles) over all Arrow
    batches. Each task sends one vector; ``fan_in`` tasks add them up, and the
    driver gets that many, whatever the size of the input."""

    def add(first: bool):
        def run(batches):
            total, any_rows = np.zeros(length), False
            for batch in batches:
                any_rows = any_rows or batch.num_rows > 0
                if first:
                    if batch.num_rows:
                        total += fn(batch)
                else:
                    for v in batch.column(0):
                        total += np.frombuffer(v.as_buffer(), dtype=np.float64)
            if any_rows:
                yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["v"])

        return run

    rows = df.mapInArrow(add(True), "v binary").repartition(fan_in).mapInArrow(add(False), "v binary").toArrow()
    total = np.zeros(length)
    for v in rows.column(0):
        total += np.frombuffer(v.as_buffer(), dtype=np.float64)
    return total
