"""Every registered query against its DuckDB oracle at sf0.001 (fast subset)."""

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()
OTHERS = set(E.LLM_QUERIES)  # they have tests of their own


def _norm(v):
    # sortable, type-tagged form (None sorts first)
    if v is None:
        return (0, "")
    return (1, repr(round(v, 6) if isinstance(v, float) else v))


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["share_id", "fh_id", "cid", "rid", "see_time"]


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(set(E.oracle_sql()) - OTHERS))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    res = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(ocols)
    order = sorted(df.columns)
    srows = sorted(tuple(_norm(r[c]) for c in order) for r in df.collect())
    idx = [ocols.index(c) for c in order]
    orows = sorted(tuple(_norm(r[i]) for i in idx) for r in res.fetchall())
    assert srows == orows
