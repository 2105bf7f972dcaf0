import numpy as np
from pyspark.sql import functions as F

from conftest import SF_MID
from strata.llm import neighbours as N


def brute(rows, asked, k):
    ok = [(i, np.array(v, dtype=float)) for i, v in rows if i is not None and v is not None and None not in v]
    ok = [(i, v) for i, v in ok if len(v) == 4 and np.isfinite(v).all() and v.any()]
    out = {}
    for i, q in {i: v for i, v in reversed(ok)}.items():
        if asked(i):
            best = sorted((-float((q * v).sum()), j) for j, v in ok if j != i)[:k]
            out[i] = [(j, -s) for s, j in best]
    return out


def test_recall_on_the_test_table(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{SF_MID}/embeddings.parquet").collect()]
    ids, x = np.array([i for i, _ in rows]), np.array([v for _, v in rows], dtype=float)
    found = {}
    for r in N.op4_neighbours(spark, SF_MID).collect():
        found.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    hit = total = 0
    for i in np.flatnonzero(ids % 20 == 0):
        score = (x * x[i]).sum(1)
        score[i] = -np.inf
        want = ids[np.lexsort((ids, -score))[:20]]
        got = sorted(found[ids[i]])
        assert [g[0] for g in got] == list(range(1, 21)) and [g[2] for g in got] == sorted((g[2] for g in got), reverse=True)
        hit += len(set(want) & {g[1] for g in got})
        total += 20
    assert hit / total >= 0.9


def test_all_lists_probed_equals_brute_force_with_ties_and_odd_rows(spark):
    r = np.random.default_rng(1)
    rows = [(i, r.normal(size=4).round(1).tolist()) for i in range(60)]
    rows += [(i, [1.0, 2.0, -1.0, 0.5]) for i in range(100, 140)]  # one common vector
    rows += [(200, None), (201, []), (202, [0.0] * 4), (203, [1.0, None, 0.0, 1.0]), (204, [float("nan")] * 4), (205, [float("inf"), 1.0, 1.0, 1.0]),
             (206, [1.0]), (None, [1.0] * 4), (7, rows[7][1])]
    table = spark.createDataFrame([(i, v, 0) for i, v in rows], "vec_id long, embedding array<double>, vector int")
    out = {}
    for x in N.nearest(table, F.col("id") % 20 == 0, k=8, share=1.0).collect():
        out.setdefault(x["query_id"], {})[x["rank"]] = (x["vec_id"], x["score"])
    want = brute(rows, lambda i: i % 20 == 0, 8)
    assert set(out) == set(want)
    for q, best in want.items():
        got = [out[q][k] for k in range(1, 9)]
        assert [g[0] for g in got] == [b[0] for b in best]
        assert np.allclose([g[1] for g in got], [b[1] for b in best], atol=1e-12)


def test_few_and_no_candidates(spark):
    schema = "vec_id long, embedding array<float>"
    few = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 0.5])], schema)
    assert [tuple(r) for r in N.nearest(few, F.col("id") == 0).collect()] == [(0, 1, 1, 0.5)]
    assert N.nearest(spark.createDataFrame([], schema), F.col("id") == 0).count() == 0
    assert N.nearest(few, F.col("id") == 9).count() == 0


def test_as_many_as_there_are_and_copies_cost_no_lists(spark):
    r = np.random.default_rng(4)
    schema = "vec_id long, embedding array<double>"
    for n in (16, 20, 30):
        rows = [(i, r.normal(size=4).tolist()) for i in range(n)] + [(0, [1.0, 0.0, 0.0, 0.0])]
        got = N.nearest(spark.createDataFrame(rows, schema), F.col("id") < 5).groupBy("query_id").count().collect()
        assert {x["query_id"]: x["count"] for x in got} == {i: min(20, n - (i == 0)) for i in range(5)}, n
    x = r.normal(size=(300, 8))
    x[::3] = x[0]
    index = N.Index(x, 17)
    assert len(np.unique(index.assign(x / np.linalg.norm(x, axis=1, keepdims=True)))) == len(index.centroids)
    ids = np.arange(300)
    lists = index.assign(x)
    q, found, _ = N.search(index, ids, x, lists, ids, x, 20)
    hit = 0
    for i in ids:
        score = (x * x[i]).sum(1)
        score[i] = -np.inf
        hit += (score[found[q == i]] >= np.sort(score)[-20] - 1e-12).sum()
    assert hit / (300 * 20) >= 0.9
