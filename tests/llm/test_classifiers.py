import zlib

import numpy as np
from pyspark.sql import functions as F

from conftest import SF_MID
from strata.llm import quality as Q, toxicity as T
from strata.llm.labels import held_out

ODD = [(9001, None), (9002, ""), (9003, "\n \t"), (9004, "word " * 30_000), (None, "Some text."), (9001, None)]


def odd(spark, rows=ODD):
    return spark.createDataFrame([(i, t, 1.0, "x") for i, t in rows], "doc_id long, text string, score double, rest string")


def labels(spark, rows=()):
    return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int")


def accuracy(spark, query, target):
    rows = query(spark, SF_MID).join(spark.read.parquet(f"{SF_MID}/labels.parquet"), "doc_id").where("held_out")
    right = [(r["predicted"] == r[target], r[target]) for r in rows.collect()]
    return [np.mean([ok for ok, y in right if y == k]) for k in (0, 1)]


def test_held_out_is_by_crc32(spark):
    rows = spark.range(50).select("id", held_out(F.col("id")).alias("h")).collect()
    assert all(r["h"] == (zlib.crc32(str(r["id"]).encode()) % 4 == 2) for r in rows)


def test_quality_on_held_out_rows(spark):
    low, high = accuracy(spark, Q.op1_quality, "quality")
    assert low >= 0.9 and high >= 0.9


def test_toxicity_on_held_out_rows(spark):
    clean, toxic = accuracy(spark, T.op3_toxicity, "toxic")
    assert clean >= 0.95 and toxic >= 0.6


def test_odd_rows_get_scores(spark):
    for fn in (Q.quality_scores, T.toxicity_scores):
        for given in (labels(spark), labels(spark, [(9002, 1, 0), (9004, 0, 1), (9004, None, None), (None, 1, 1), (9003, 1, 0)])):
            rows = fn(odd(spark), given).collect()
            assert len(rows) == len(ODD) and all(0 <= r["score"] <= 1 for r in rows)
        assert fn(odd(spark).limit(0), labels(spark)).count() == 0


def test_isotonic_is_the_pooled_mean():
    got = Q.isotonic(np.array([1, 2, 0, 1, 1.0]), np.array([1.0, 0, 0, 1, 0]))
    assert np.allclose(got, [1 / 3, 1 / 3, 1 / 3, 0.5, 0.5])


def test_features_approximate_a_gaussian_kernel():
    r = np.random.default_rng(0)
    d = 12
    model = Q.QualityModel(np.zeros(d), np.ones(d), None, None, features=20_000)
    x = r.normal(size=(30, d))
    z = model.features(x)[:, :-1]
    exact = np.exp(-((x[:, None] - x[None]) ** 2).sum(-1) / (2 * d))
    assert np.abs(z @ z.T - exact).max() < 0.05


def test_offending_sentences_are_located(spark):
    rows, marks = [], []
    for i in range(400):
        bad = i % 4 == 0
        text = f"Plain line {i % 7} here. " + ("Ünd you absolute zorgle! " if bad else "Ünd a nice day! ") + "More words follow."
        rows.append((i, text))
        marks.append((i, 1, int(bad)))
    out = {r["id"]: r for r in T.toxicity_scores(odd(spark, rows), labels(spark, marks), with_rest=True).collect()}
    for i, text in rows:
        got = [text[s["start"]:s["end"]] for s in out[i]["offending"]]
        assert got == (["Ünd you absolute zorgle"] if i % 4 == 0 else [])
        assert (out[i]["score"] >= 0.3) == (i % 4 == 0) and out[i]["rest"]["rest"] == "x"


def test_noisy_or():
    got = T.noisy_or(np.array([0, 0, 2]), np.array([0.5, 0.5, 1.0]), 3, 0.1)
    assert np.allclose(got, [1 - 0.9 * 0.25, 0.1, 1])
