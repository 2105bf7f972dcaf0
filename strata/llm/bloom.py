"""Bloom filters over 64-bit hashes: built by Spark, tested in numpy.

A filter is an array of 64-bit words. Building emits, from each task, one row
for each word that it sets, combines the rows by ``bit_or`` and collects at
most ``bits / 64`` rows, whatever the number of keys.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from strata.llm.common import map_arrow
from strata.llm.words import mix

#: largest filter that is sent to the executors (8 MB)
MAX_BITS = 1 << 26


def bits_for(keys: int, per_key: int = 10, most: int = MAX_BITS) -> int:
    """A power of two of at least ``per_key`` bits a key, within bounds."""
    return min(most, max(1 << 10, 1 << (max(1, keys * per_key) - 1).bit_length()))


def places(keys: np.ndarray, bits: int, k: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """For each key its word and the mask of its k bits, all in that word."""
    keys = keys.view(np.uint64) if keys.dtype == np.int64 else keys.astype(np.uint64)
    a = mix(keys ^ np.uint64(0xA5A5A5A5 + 2 * seed))
    b = mix(a + np.uint64(0x51ED270B))
    mask = np.zeros(len(keys), dtype=np.uint64)
    for j in range(k):
        mask |= np.uint64(1) << ((b >> np.uint64(6 * j)) & np.uint64(63))
    return (a & np.uint64(bits // 64 - 1)).astype(np.int64), mask


class Bloom:
    """``bits`` (a power of two) bits, ``k`` (at most 10) of them for each key."""

    def __init__(self, words: np.ndarray, bits: int, k: int, seed: int):
        self.words, self.bits, self.k, self.seed = words, bits, k, seed

    def has(self, keys: np.ndarray) -> np.ndarray:
        word, mask = places(keys, self.bits, self.k, self.seed)
        return (self.words[word] & mask) == mask


def build(keys: DataFrame, column: str, bits: int, k: int = 5, seed: int = 0) -> Bloom:
    """The filter of a long column; nulls are no keys."""

    def words_of(batch: pa.RecordBatch):
        own = batch.column(0).drop_null().to_numpy(zero_copy_only=False)
        word, mask = places(own, bits, k, seed)
        order = np.argsort(word, kind="stable")
        word, mask = word[order], mask[order]
        first = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1]))) if len(word) else word
        value = np.bitwise_or.reduceat(mask, first) if len(word) else mask
        yield {"word": word[first], "value": value.view(np.int64)}

    rows = (map_arrow(keys.select(F.col(column).cast("long")), "word bigint, value bigint", words_of)
            .groupBy("word").agg(F.bit_or("value").alias("value")).toArrow())
    words = np.zeros(bits // 64, dtype=np.uint64)
    words[rows.column("word").to_numpy()] = rows.column("value").to_numpy().view(np.uint64)
    return Bloom(words, bits, k, seed)
