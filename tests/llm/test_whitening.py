"""Whitening against a plain eigendecomposition."""

import numpy as np
import pytest

from conftest import SF_MID
from strata.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, x int, component string, n string"


def _plain(rows):
    usable = [(i, np.array(v, dtype=np.float32).astype(float)) for i, v in rows
              if v is not None and len(v) and all(c is not None and np.isfinite(c) for c in v)]
    lengths = [len(v) for _, v in usable]
    dim = max(set(lengths), key=lambda d: (lengths.count(d), d))
    usable = [(i, v) for i, v in usable if len(v) == dim]
    x = (np.floor(64 * np.array([v for _, v in usable])) + 1_000_000).astype(np.int64)
    fit = np.unique(x, axis=0)
    n, total = len(fit), fit.sum(axis=0)
    centred = fit - total / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    return [i for i, _ in usable], x, n, total, values[::-1], vectors[:, ::-1]


def _check(got, rows):
    ids, x, n, total, values, vectors = _plain(rows)
    k = min(16, int((values > 1e-12 * values.sum()).sum()))
    white = (x - total / n) @ vectors[:, :k] / np.sqrt(values[:k])
    deviation = [sum((n * int(a) - int(t)) ** 2 for a, t in zip(r, total)) for r in x]
    assert len(got) == len(ids) * k
    mine = {(r["vec_id"], r["component"]): r for r in got}
    for c in range(k):
        column = np.array([mine[i, c + 1]["whitened"] for i in ids])
        sign = np.sign(column @ white[:, c])
        assert np.abs(column * sign - white[:, c]).max() < 1e-7
        explained = {mine[i, c + 1]["explained"] for i in ids}
        assert len(explained) == 1 and explained.pop() == pytest.approx(values[c] / values.sum(), rel=1e-9)
    assert [mine[i, 1]["deviation"] for i in ids] == deviation
    assert {r["n"] for r in got} == {n}
    assert {r["identity_error"] for r in got}.pop() < 1e-9


def test_given_vectors(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{SF_MID}/embeddings.parquet").collect()]
    _check(whitening.op13_whitening(spark, SF_MID).collect(), rows)


def test_unusable_vectors_and_copies(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [float(v) for v in rng.standard_normal(6)]) for i in range(120)]
    rows += [(1000 + i, rows[0][1]) for i in range(60)]
    bad = [(2000, None), (2001, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (2002, [float("nan")] * 6), (2003, [float("inf")] + [0.0] * 5), (2004, []), (2005, [1.0, 2.0])]
    df = spark.createDataFrame([(i, v, 1, "c", "n") for i, v in rows + bad], SCHEMA)
    _check(whitening.whiten(df).collect(), rows + bad)


def test_components_without_variance_have_no_rows(spark):
    rng = np.random.default_rng(6)
    rows = [(i, [float(a), float(b), 0.5, float(a)]) for i, (a, b) in enumerate(rng.standard_normal((50, 2)))]
    got = whitening.whiten(spark.createDataFrame([(i, v, 1, "c", "n") for i, v in rows], SCHEMA)).collect()
    assert {r["component"] for r in got} == {1, 2}
    _check(got, rows)
    same = spark.createDataFrame([(i, [0.25, 0.5], 1, "", "") for i in range(9)], SCHEMA)
    assert whitening.whiten(same).collect() == []


def test_empty_and_null_ids(spark):
    assert whitening.whiten(spark.createDataFrame([], SCHEMA)).collect() == []
    rows = [(None, [0.5, 0.25], 1, "", ""), (None, [0.25, 0.75], 1, "", ""), (3, [0.0, 0.0], 1, "", "")]
    got = whitening.whiten(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == 6 and sum(r["vec_id"] is None for r in got) == 4


def test_huge_entries_are_defined(spark):
    rows = [(i, [1e30 if i == 0 else 0.1 * i, 0.2], 1, "", "") for i in range(5)]
    got = whitening.whiten(spark.createDataFrame(rows, SCHEMA)).collect()
    assert all(r["deviation"] is None or r["deviation"] >= 0 for r in got)


def test_filter_needs_passes_and_agrees_with_wide_spectra(spark):
    """A wide table: the block is smaller than the dimension."""
    rng = np.random.default_rng(8)
    basis = rng.standard_normal((80, 80))
    data = rng.standard_normal((400, 80)) @ basis
    rows = [(i, [float(np.float32(c)) for c in v]) for i, v in enumerate(data)]
    _check(whitening.whiten(spark.createDataFrame([(i, v, 1, "", "") for i, v in rows], SCHEMA)).collect(), rows)
