"""Embedding whitening by Chebyshev-filtered subspace iteration.

The covariance is never formed. A pass over the distinct vectors multiplies
it with a block of directions: each task centres its rows, sums X'(XQ), and
the partial sums are added up in a tree. A Chebyshev polynomial of the
covariance, one pass a degree, damps the unwanted end of the spectrum; QR and
a Rayleigh-Ritz step then give eigenpairs, and filtering goes on until the
residuals of all wanted pairs certify them to rounding.

The driver holds matrices of dimension x block, never rows. The interval to be
damped reaches from a Lanczos estimate of the smallest eigenvalue (which only
sets the speed) up to the smallest Ritz value of the block.

Defined cases: vectors that are null, empty, or hold null or non-finite
entries are left out; where lengths differ, only vectors of the most frequent
length (of equally frequent ones the longest) can share a covariance and the
others are left out too; scaled entries beyond 2^46
count as 2^46. A component
without variance cannot be whitened and has no rows: a table of equal vectors,
or an empty one, gives an empty table. Null ids and repeated rows are rows like
any other; a ``deviation`` that no long holds is null; extra columns are not
read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from strata.llm.common import field, read, saved

COMPONENTS = 16
#: further directions carried along, so that the filter has a gap to work on
GUARD = 16
DEGREE, LANCZOS, MOST_ROUNDS = 12, 10, 60
#: residual of a certified pair, relative to the largest eigenvalue
CERTIFIED = 2e-13
SCALE, SHIFT, LIMIT = 64, 1_000_000, float(2**46)
SEED = 29


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def tree_sum(df: DataFrame, fn, length: int) -> np.ndarray:
    """The sum of ``fn`` (a vector) over all Arrow batches. Tasks send one
    vector each; as many as the root of the number of tasks add them up, so
    neither they nor the driver get more than that many."""
    def partial(batches):
        total, any_rows = np.zeros(length), False
        for batch in batches:
            if batch.num_rows:
                total, any_rows = total + fn(batch), True
        if any_rows:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["v"])

    def added(batches):
        total, any_rows = np.zeros(length), False
        for batch in batches:
            for v in batch.column(0):
                total, any_rows = total + np.frombuffer(v.as_buffer()), True
        if any_rows:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["v"])

    rows = df.mapInArrow(partial, "v binary")
    tasks = df.rdd.getNumPartitions()
    if tasks > 64:
        rows = rows.repartition(math.isqrt(tasks)).mapInArrow(added, "v binary")
    total = np.zeros(length)
    for v in rows.toArrow().column(0):
        total += np.frombuffer(v.as_buffer())
    return total


def scaled(vectors: DataFrame, vec: str) -> DataFrame:
    """Rows with ``x``, the scaled integer vector, of usable vectors."""
    entry = lambda c: (F.floor(F.greatest(F.least(c.cast("double") * SCALE, F.lit(LIMIT)), F.lit(-LIMIT))) + SHIFT).cast("long")
    usable = F.forall(vec, lambda c: F.coalesce(c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")), F.lit(False)))
    return vectors.where(F.col(vec).isNotNull() & (F.size(vec) > 0) & usable).withColumn("x", F.transform(vec, entry))


class Covariance:
    """Products with the covariance of the rows ``x`` of a table."""

    def __init__(self, fit: DataFrame, dim: int):
        self.fit, self.dim, self.passes = fit, dim, 0

        def counts(batch):
            x = _matrix(batch.column(0), dim)
            # 16 bits at a time: sums of up to 2^37 rows stay exact in doubles
            digits = [x >> 32, (x >> 16) & 0xFFFF, x & 0xFFFF]
            return np.concatenate([*[d.sum(axis=0).astype(float) for d in digits], [len(x)]])

        sums = tree_sum(fit, counts, 3 * dim + 1)
        self.n = int(sums[-1])
        self.total = [(int(h) << 32) + (int(m) << 16) + int(low) for h, m, low in zip(sums[:dim], sums[dim:2 * dim], sums[2 * dim:])]
        self.mean_whole = np.array([t // max(self.n, 1) for t in self.total], dtype=np.int64)
        self.mean_rest = np.array([(t % max(self.n, 1)) / max(self.n, 1) for t in self.total])

    def centred(self):
        whole, rest, dim = self.mean_whole, self.mean_rest, self.dim
        return lambda column: (_matrix(column, dim) - whole).astype(float) - rest

    def times(self, block: np.ndarray) -> np.ndarray:
        """The covariance times a block of columns, in one pass."""
        centre, m = self.centred(), block.shape[1]

        def fn(batch):
            x = centre(batch.column(0))
            return (x.T @ (x @ block)).ravel()

        self.passes += 1
        return tree_sum(self.fit, fn, self.dim * m).reshape(self.dim, m) / self.n

    def trace(self) -> float:
        centre = self.centred()
        return float(tree_sum(self.fit, lambda b: np.array([np.square(centre(b.column(0))).sum()]), 1)[0]) / self.n


def _least(cov: Covariance, rng, steps: int) -> float:
    """About the smallest eigenvalue, by Lanczos with full orthogonalisation."""
    steps = min(steps, cov.dim)
    basis = [rng.standard_normal(cov.dim)]
    basis[0] /= np.linalg.norm(basis[0])
    a, b = [], []
    for _ in range(steps):
        w = cov.times(basis[-1][:, None])[:, 0]
        a.append(float(w @ basis[-1]))
        for _ in range(2):
            for q in basis:
                w = w - (w @ q) * q
        norm = float(np.linalg.norm(w))
        if norm <= 1e-12 * max(abs(x) for x in a) or len(basis) == steps:
            b.append(norm)
            break
        b.append(norm)
        basis.append(w / norm)
    t = np.diag(a) + np.diag(b[:len(a) - 1], 1) + np.diag(b[:len(a) - 1], -1)
    values, vectors = np.linalg.eigh(t)
    return max(0.0, float(values[0] - abs(b[-1] * vectors[-1, 0])))


def _filtered(cov: Covariance, x: np.ndarray, first: np.ndarray, low: float, high: float, top: float, degree: int) -> np.ndarray:
    """A Chebyshev polynomial of the covariance times ``x``: small on
    [low, high], scaled to 1 at ``top``. ``first`` is the covariance times x."""
    centre, half = (high + low) / 2, max((high - low) / 2, 1e-3 * high)
    sigma = first_sigma = half / (top - centre)
    before, now = x, (first - centre * x) * (sigma / half)
    for _ in range(degree - 1):
        after = 1 / (2 / first_sigma - sigma)
        before, now = now, (cov.times(now) - centre * now) * (2 * after / half) - before * (sigma * after)
        sigma = after
    return now


def leading_pairs(cov: Covariance, k: int, guard: int = GUARD, degree: int = DEGREE) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues, falling, and their unit eigenvectors."""
    rng = np.random.default_rng(SEED)
    q = np.linalg.qr(rng.standard_normal((cov.dim, min(cov.dim, k + guard))))[0]
    low, best = None, np.inf
    for _ in range(MOST_ROUNDS):
        product = cov.times(q)
        small = q.T @ product
        values, turn = np.linalg.eigh((small + small.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        x, first = q @ turn, product @ turn
        residual = np.linalg.norm(first - x * values, axis=0)[:k].max()
        top = max(float(values[0]), 0.0)
        if residual <= CERTIFIED * top or not top > 0:
            return values[:k], x[:, :k]
        if residual <= 50 * CERTIFIED * top and residual > best / 2:  # as far as doubles go
            return values[:k], x[:, :k]
        best = min(best, residual)
        if low is None:
            low = _least(cov, rng, LANCZOS)
        high = float(values[-1])
        if high - low <= 1e-9 * top:  # the block's low end has no spectrum left to damp below it
            low = 0.0
        q = np.linalg.qr(_filtered(cov, x, first, min(low, 0.98 * high), high, top * (1 + 1e-12) if top > high else high * 1.01, degree))[0]
    raise RuntimeError(f"eigenpairs not certified after {MOST_ROUNDS} rounds: residual {best:.3g} of {top:.3g}")


def whiten(vectors: DataFrame, key: str = "vec_id", vec: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """For each usable row and component: the row's id, ``component``, ``n``,
    ``deviation``, ``whitened``, ``explained``, ``identity_error``."""
    schema = f"{field(vectors, key)}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    rows = saved(scaled(vectors.select(key, vec), vec).select(key, "x"), "whiten-rows")
    length = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.col("count").desc(), F.col("d").desc()).first()
    empty = vectors.sparkSession.createDataFrame([], schema)
    if length is None:
        return empty
    dim = length["d"]
    rows = rows.where(F.size("x") == dim)
    cov = Covariance(saved(rows.select("x").distinct(), "whiten-fit"), dim)
    trace = cov.trace()
    values, directions = leading_pairs(cov, min(components, dim))
    keep = int(np.sum(values > 1e-12 * max(trace, 0.0))) if trace > 0 else 0
    if not keep:
        return empty
    values, directions = values[:keep], directions[:, :keep]
    project = directions / np.sqrt(values)
    centre = cov.centred()

    def products(batch):
        w = centre(batch.column(0)) @ project
        return np.concatenate([(w.T @ w).ravel(), w.sum(axis=0)])

    sums = tree_sum(cov.fit, products, keep * keep + keep) / cov.n
    mean = sums[keep * keep:]
    error = float(np.abs(sums[:keep * keep].reshape(keep, keep) - np.outer(mean, mean) - np.eye(keep)).max())
    n, total, explained = cov.n, cov.total, values / trace

    def out(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                x = _matrix(part.column(1), dim)
                white = centre(part.column(1)) @ project
                k = part.num_rows
                yield pa.RecordBatch.from_arrays([
                    part.column(0).take(np.repeat(np.arange(k), keep)),
                    pa.array(np.tile(np.arange(1, keep + 1, dtype=np.int32), k)), pa.array(np.full(k * keep, n)),
                    pa.array(_deviation(x, n, total), pa.int64()).take(np.repeat(np.arange(k), keep)), pa.array(white.ravel()),
                    pa.array(np.tile(explained, k)), pa.array(np.full(k * keep, error))],
                    names=[key, "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.select(key, "x").mapInArrow(out, schema)


def _deviation(x: np.ndarray, n: int, total: list[int]) -> list[int | None]:
    """Sums of (n*x - total)^2, exact; null where no long holds them."""
    most = n * int(np.abs(x).max(initial=0)) + max(abs(t) for t in total)
    if most < 2**62:
        off = x * n - np.array(total, dtype=np.int64)
        if int(np.abs(off).max(initial=0)) ** 2 * x.shape[1] < 2**63:
            return np.square(off).sum(axis=1).tolist()
    sums = (sum((n * v - t) ** 2 for v, t in zip(row, total)) for row in x.tolist())
    return [s if s < 2**63 else None for s in sums]


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(read(spark, sf_dir, "embeddings"))
