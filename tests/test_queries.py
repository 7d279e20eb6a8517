"""Every registered query against its SQL counterpart on the smallest data."""

import math
import os
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract

FOLDER = Path(os.environ.get("FUNDSIFT_TESTDATA", "/root/testdata/sf0.001"))
pytestmark = pytest.mark.skipif(not FOLDER.exists(), reason="no test data")
# The training-data queries have tests of their own.
QUERIES = {name: run for name, run in contract.queries().items() if name not in contract.LLM_QUERIES}
SQL = {name: sql for name, sql in contract.oracle_sql().items() if name in QUERIES}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for file in FOLDER.glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def comparable(columns, table):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    text = [tuple(repr(float(v)) if isinstance(v, float) else str(v) for v in row) for row in table]
    assert not any(isinstance(v, float) and math.isnan(v) for row in table for v in row)
    return sorted(tuple(row[i] for i in order) for row in text)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, str(FOLDER))
    result = duck.execute(SQL[name])
    columns = [c[0] for c in result.description]
    assert sorted(df.columns) == sorted(columns)
    want = comparable(columns, result.fetchall())
    assert comparable(df.columns, df.collect()) == want


def test_entry(spark):
    assert contract.entry(spark).count() > 0
