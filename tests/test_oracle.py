"""Every registered query against its DuckDB oracle on the smoke data."""

import duckdb
import pytest

import __spark_entry__ as ent
from tarmac.plans.catalog import QUERIES
from tarmac.plans.oracle import oracle
from tools.oracle_check import TABLES, rows_of

SMOKE = "/root/testdata/sf0.001"
SQL = oracle()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMOKE}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(SQL)
    assert set(SQL) <= set(ent.oracle_sql()) and set(QUERIES) <= set(ent.queries())


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, duck, name):
    df = ent.queries()[name](spark, SMOKE)
    cols = df.columns
    srows = [tuple(r) for r in df.collect()]
    res = duck.execute(SQL[name])
    dcols = [d[0] for d in res.description]
    assert sorted(cols) == sorted(dcols)
    drows = res.fetchall()
    a = rows_of([[r[cols.index(c)] for c in sorted(cols)] for r in srows])
    b = rows_of([[r[dcols.index(c)] for c in sorted(cols)] for r in drows])
    assert a == b


def test_entry_smoke(spark):
    df = ent.entry(spark)
    assert df.count() > 0
    assert df.columns == ["Route", "ArrDelayBucket", "flights", "mean_arr_delay", "mean_dep_delay"]
