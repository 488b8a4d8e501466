"""Rows of the subpackage's queries against their SQL, over the smallest tables."""

import glob
import os

import pytest

from biblioscope.llm import queries

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data here")


def _plain(v):
    return repr(v + 0.0) if isinstance(v, float) else str(v)


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_rows_equal_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for p in glob.glob(f"{DATA}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    df = queries.queries()[name](spark, DATA)
    want = con.sql(queries.oracle_sql()[name])
    columns = sorted(df.columns)
    assert columns == sorted(want.columns)
    at = [want.columns.index(c) for c in columns]
    assert sorted(tuple(_plain(r[c]) for c in columns) for r in df.collect()) == sorted(tuple(_plain(r[i]) for i in at) for r in want.fetchall())
