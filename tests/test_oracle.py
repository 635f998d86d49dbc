"""Every registered query against its SQL oracle (DuckDB) on the smallest driver tables."""

import pytest

import __spark_entry__ as E
from tests.oracle_check import digest, duck

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert len(rows) == len(drows)
    assert digest(df.columns, rows)[0] == digest(dcols, drows)[0]


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "buy_order_id" in df.columns
