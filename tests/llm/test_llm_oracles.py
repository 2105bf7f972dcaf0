"""Registered queries of the package against their SQL."""

import duckdb
import pytest

from conftest import SF_SMALL
from strata.llm import queries as L


def _norm(v):
    return (0, "") if v is None else (1, repr(round(v, 6) if isinstance(v, float) else v))


@pytest.mark.parametrize("name", sorted(L.ORACLES))
def test_query_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark"):
        con.execute(f"create view {t} as select * from read_parquet('{SF_SMALL}/{t}.parquet')")
    df = L.QUERIES[name](spark, SF_SMALL)
    res = con.execute(L.ORACLES[name])
    names = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(names)
    order = sorted(names)
    got = sorted(tuple(_norm(r[c]) for c in order) for r in df.collect())
    want = sorted(tuple(_norm(r[names.index(c)]) for c in order) for r in res.fetchall())
    assert got == want


def test_all_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in L.QUERIES) == list(range(1, 14))
