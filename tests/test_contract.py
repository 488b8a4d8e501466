"""The entry module: names, schemas and SQL of every query, and a run of a few over the smallest tables."""

import glob
import os

import pytest

import __spark_entry__ as entry
from biblioscope.plans import registry

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data here")


def _plain(v):
    if isinstance(v, float):
        return repr(v + 0.0)
    if isinstance(v, (list, tuple)):
        return str([_plain(x) for x in v])
    return str(v)


def test_sql_belongs_to_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["drug", "disease", "subject_id", "object_id", "confidence", "evidence_count"] and df.count() > 0


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_rows_equal_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for p in glob.glob(f"{DATA}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    df = entry.queries()[name](spark, DATA)
    want = con.sql(entry.oracle_sql()[name])
    columns = sorted(df.columns)
    assert columns == sorted(want.columns)
    at = [want.columns.index(c) for c in columns]
    assert sorted(tuple(_plain(r[c]) for c in columns) for r in df.collect()) == sorted(tuple(_plain(r[i]) for i in at) for r in want.fetchall())
