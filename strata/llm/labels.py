"""Held-out rows and training labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

FOLDS, HELD_OUT = 4, 2


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id as text leaves the held-out remainder; false
    for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(False))


def training_labels(labels: DataFrame, target: str, doc_id: str = "doc_id") -> DataFrame:
    """id, y of labelled rows that are not held out. Null labels are none;
    of several labels of one id the largest counts."""
    return (labels.where(F.col(doc_id).isNotNull() & F.col(target).isNotNull() & ~held_out(F.col(doc_id)))
            .groupBy(F.col(doc_id).alias("lid")).agg(F.max(F.col(target).cast("double")).alias("y")))
