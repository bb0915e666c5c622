"""The queries of this subpackage that have SQL, against it."""

import glob
import os

import duckdb
import pytest

from sievewright.llm import queries

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM read_parquet('{path}')")
    return con


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query(spark, duck, name):
    got = queries.queries()[name](spark, FOLDER)
    columns = sorted(got.columns)
    want = duck.execute(queries.oracle_sql()[name]).df()
    assert sorted(want.columns) == columns
    rows = lambda df: sorted(map(repr, df[columns].astype(object).where(df[columns].notna(), None).itertuples(index=False, name=None)))
    assert rows(got.toPandas()) == rows(want)
