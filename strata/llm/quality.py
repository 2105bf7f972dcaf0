"""Quality classifier: random Fourier features of document statistics.

Each text is reduced to statistics of its bytes, words and lines. Standardised
statistics are mapped to random Fourier features, whose inner products
approximate a Gaussian kernel. The normal equations of ridge regression are
summed over partitions and solved on the driver (a matrix of fixed size);
isotonic regression over a histogram of the training scores, of fixed size
too, turns ridge scores into probabilities. All labelled rows are used.

Defined cases: null and empty texts have statistics like any other text and
get a score; a statistic without spread counts as nought; without labels every
score is 0.5; repeated rows give repeated rows; null ids get a score and are
never trained on; an empty table gives an empty table.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from strata.llm.common import map_arrow, read, saved
from strata.llm.labels import held_out, training_labels
from strata.llm.sums import partition_sum
from strata.llm.words import SPACE_WORDS, word_tables

FEATURES, RIDGE, SEED = 256, 0.1, 11
BINS, LOW, HIGH = 2048, -0.5, 1.5
THRESHOLD = 0.7

_CLASSES = [b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", b"0123456789", b" ", b"\n\r", b"\t", b".", b",", b"!?",
            b"|", b"#", b"*", b"%", b"$", b"&", b"<>{}[]=\\/_~^@", b"\"'()-:;+", bytes(range(0x80, 0x100))]
_CLASS = np.zeros((256, len(_CLASSES)))
for _i, _c in enumerate(_CLASSES):
    _CLASS[list(_c), _i] = 1
N_STATS = len(_CLASSES) + 12


def statistics(texts: pa.Array):
    """(row range, matrix of statistics) of runs of texts."""
    for a, b, table in word_tables(texts, SPACE_WORDS):
        n = b - a
        out = np.zeros((n, N_STATS))
        size = (table.stop - table.start).astype(float)
        upper = (table.data[table.start] >= 0x41) & (table.data[table.start] <= 0x5A) if len(table.start) else np.empty(0, bool)
        ends = np.isin(table.data[table.stop - 1], list(b".!?")) if len(table.start) else np.empty(0, bool)
        for d in range(n):
            raw = table.data[table.offsets[d]:table.offsets[d + 1]]
            lo, hi = table.bounds[d], table.bounds[d + 1]
            if not len(raw):
                continue
            row = out[d]
            row[:len(_CLASSES)] = np.bincount(raw, minlength=256) @ _CLASS / len(raw)
            lines = raw.tobytes().split(b"\n")
            full = [x for x in lines if x]
            k = hi - lo
            w = size[lo:hi]
            distinct, times = np.unique(table.hashes[lo:hi], return_counts=True)
            row[len(_CLASSES):] = (
                np.log1p(len(raw)), np.log1p(k), np.log1p(len(full)),
                w.mean() if k else 0, w.std() if k else 0, np.log1p(w.max()) if k else 0,
                len(distinct) / k if k else 0, times.max() / k if k else 0, len(set(full)) / len(full) if full else 1,
                upper[lo:hi].mean() if k else 0, ends[lo:hi].mean() if k else 0, np.log1p(k / max(1, len(full))))
        yield a, b, out


def statistics_table(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """id, stats (doubles as bytes), one row per row of ``docs``."""
    kind = docs.schema[doc_id].dataType.simpleString()

    def scan(batch: pa.RecordBatch):
        for a, b, x in statistics(batch.column(1)):
            yield {"id": batch.column(0).slice(a, b - a), "stats": [r.tobytes() for r in x]}

    return map_arrow(docs.select(doc_id, text), f"id {kind}, stats binary", scan)


def _matrix(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.float64).reshape(len(column), -1)


def isotonic(weight: np.ndarray, total: np.ndarray) -> np.ndarray:
    """Non-decreasing means of weighted bins by pooling adjacent violators;
    bins without weight take their pool's value by carrying forward."""
    level, mass, span = [], [], []
    for w, s in zip(weight, total):
        level.append(s / w if w else (level[-1] if level else 0.0))
        mass.append(w)
        span.append(1)
        while len(level) > 1 and level[-2] >= level[-1]:
            w2 = mass[-2] + mass[-1]
            merged = (level[-2] * mass[-2] + level[-1] * mass[-1]) / w2 if w2 else level[-1]
            n = span[-2] + span[-1]
            del level[-1], mass[-1], span[-1]
            level[-1], mass[-1], span[-1] = merged, w2, n
    return np.repeat(level, span)


class QualityModel:
    """Standardisation, Fourier features, ridge weights and calibration."""

    def __init__(self, mean, scale, weights, calibration, features: int = FEATURES, seed: int = SEED):
        rng = np.random.default_rng(seed)
        d = len(mean)
        self.mean, self.scale = mean, scale
        self.omega = rng.normal(size=(d, features)) / np.sqrt(d)
        self.phase = rng.uniform(0, 2 * np.pi, features)
        self.weights, self.calibration = weights, calibration

    def features(self, stats: np.ndarray) -> np.ndarray:
        x = np.clip((stats - self.mean) / self.scale, -8, 8)
        z = np.sqrt(2 / len(self.phase)) * np.cos(x @ self.omega + self.phase)
        return np.hstack((z, np.ones((len(z), 1))))

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return self.features(stats) @ self.weights

    def score(self, stats: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(stats), 0.5)
        at = (np.arange(BINS) + 0.5) / BINS * (HIGH - LOW) + LOW
        return np.clip(np.interp(self.raw(stats), at, self.calibration), 0, 1)


def fit(training: DataFrame, features: int = FEATURES, ridge: float = RIDGE, seed: int = SEED) -> QualityModel:
    """``training``: stats, y. Three passes of partition sums."""

    def moments(batch):
        x = _matrix(batch.column(0))
        return np.concatenate((x.sum(0), (x * x).sum(0), [len(x)]))

    s = partition_sum(training.select("stats", "y"), moments, 2 * N_STATS + 1)
    n = s[-1]
    if n == 0:
        return QualityModel(np.zeros(N_STATS), np.ones(N_STATS), None, None, features, seed)
    mean = s[:N_STATS] / n
    scale = np.sqrt(np.maximum(s[N_STATS:-1] / n - mean**2, 0))
    model = QualityModel(mean, np.where(scale > 1e-9, scale, np.inf), None, None, features, seed)
    size = features + 1

    def normal(batch):
        z, y = model.features(_matrix(batch.column(0))), batch.column(1).to_numpy()
        return np.concatenate(((z.T @ z).ravel(), z.T @ y))

    s = partition_sum(training.select("stats", "y"), normal, size * size + size)
    penalty = ridge * np.eye(size)  # the kernel's noise variance; the constant is free but for rounding
    penalty[-1, -1] = 1e-9 * n
    model.weights = np.linalg.solve(s[:size * size].reshape(size, size) + penalty, s[size * size:])

    def histogram(batch):
        y = batch.column(1).to_numpy()
        at = np.clip(((model.raw(_matrix(batch.column(0))) - LOW) / (HIGH - LOW) * BINS).astype(int), 0, BINS - 1)
        return np.concatenate((np.bincount(at, minlength=BINS), np.bincount(at, weights=y, minlength=BINS)))

    s = partition_sum(training.select("stats", "y"), histogram, 2 * BINS)
    model.calibration = isotonic(s[:BINS], s[BINS:])
    return model


def quality_scores(docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text",
                   target: str = "quality") -> DataFrame:
    """id, score of each row of ``docs``, by a model of its labelled rows."""
    kind = docs.schema[doc_id].dataType.simpleString()
    stats = saved(statistics_table(docs, doc_id, text), "statistics")
    training = saved(stats.join(training_labels(labels, target), F.col("id") == F.col("lid")).select("stats", "y"), "training")
    model = docs.sparkSession.sparkContext.broadcast(fit(training))

    def score(batch: pa.RecordBatch):
        yield {"id": batch.column(0), "score": model.value.score(_matrix(batch.column(1)))}

    return map_arrow(stats, f"id {kind}, score double", score)


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract's rows over whole ``documents``."""
    out = quality_scores(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    return out.select(F.col("id").alias("doc_id"), held_out(F.col("id")).alias("held_out"), "score",
                      (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
