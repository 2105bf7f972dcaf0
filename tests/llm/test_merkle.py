"""The manifest against its definition, on ids and rows of every kind."""

import random

import pytest

from brute_merkle import manifest as plain
from strata.llm import merkle

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, tree string, pos int, leaf string"


def _rows(rows):
    return [(i, t, lang, s, n, "x", 1, "y") for i, t, lang, s, n in rows]


def _key(row):
    return tuple((v is not None, str(v)) for v in row)


def _check(spark, rows):
    df = spark.createDataFrame(_rows(rows), SCHEMA)
    got = [tuple(r) for r in merkle.manifest(df).collect()]
    want = plain([dict(doc_id=i, text=t, lang=lang, source=s, n_chars=n) for i, t, lang, s, n in rows])
    assert sorted(map(_key, got)) == sorted(map(_key, want))


def test_sparse_negative_and_repeated_ids(spark):
    rng = random.Random(5)
    ids = [rng.randrange(-2**63, 2**63) for _ in range(40)] + list(range(-30, 40)) + [65535, 65536, 65537, 2**32, 2**48]
    rows = [(i, f"Text {i} ÄB", "en", rng.choice(["a", "b", None, "", "é"]), i % 7) for i in ids]
    rows += [(3, "Other", "en", "a", 1), (3, "Other", "en", "a", 1), (3, "ZZ", None, "a", None)]
    _check(spark, rows)


def test_nulls_empty_and_long_texts(spark):
    rows = [(None, None, None, None, None), (None, "A", None, None, None), (None, "A", None, None, None),
            (1, "", "", "", 0), (2, None, "x", None, 5), (4, "Wort " * 60_000, "de", "long", 300_000), (25, "BIG", "de", "long", 3)]
    _check(spark, rows)


def test_copies_beyond_a_block(spark):
    rows = [(7, "Same", "en", "hot", 4)] * 4500 + [(i, "T", "en", "hot", 1) for i in range(100)]
    _check(spark, rows)


@pytest.mark.parametrize("n", [1, 16, 257])
def test_sizes_around_whole_runs(spark, n):
    _check(spark, [(i, f"T{i}", "en", "s", i) for i in range(n)])


def test_many_sources(spark):
    _check(spark, [(i, f"T{i}", "en", f"s{i % 40}", i) for i in range(90)])


def test_empty_table(spark):
    assert merkle.manifest(spark.createDataFrame([], SCHEMA)).collect() == []


def test_ranks_come_from_bitmaps(spark):
    keys = [("t", k, 1 + (k % 3 == 0) * 4) for k in (None, -70_000, -1, 0, 5, 63, 64, 65, 4096, 70_000, 2**40)[1:]]
    rows = spark.createDataFrame(keys, "tree string, key long, w long")
    got = {r["key"]: (r["pos"], r["n"]) for r in merkle.with_ranks(rows, "key", rows["w"], ["key"]).collect()}
    at = 0
    for _, k, w in sorted(keys, key=lambda x: x[1]):
        assert got[k] == (at, sum(x[2] for x in keys))
        at += w
