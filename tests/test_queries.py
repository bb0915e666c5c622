"""Every query against the SQL that gives the same rows."""

import glob
import math
import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry_points

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data")
QUERIES = {n: q for n, q in entry_points.queries().items() if n.startswith("q")}
SQL = entry_points.oracle_sql()


def plain(v):
    if v is None or v is pd.NA or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, float):
        return int(v) if v.is_integer() else f"{v:.9g}"
    if isinstance(v, pd.Timestamp) or hasattr(v, "isoformat"):
        t = pd.Timestamp(v)
        return (t.tz_convert(None) if t.tz else t).isoformat()
    return plain(v.item()) if hasattr(v, "item") else v


def rows(frame):
    return sorted((tuple(plain(v) for v in r) for r in frame.itertuples(index=False)), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM read_parquet('{path}')")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    got = QUERIES[name](spark, FOLDER)
    columns = sorted(got.columns)
    frame = got.select(*columns).toPandas()
    if name not in SQL:
        assert len(frame)
        return
    want = duck.execute(SQL[name]).df()
    assert sorted(want.columns) == columns
    assert rows(frame) == rows(want[columns])


def test_entry(spark):
    assert entry_points.entry(spark).count() == 1
