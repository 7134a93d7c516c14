"""Every query of the problems with SQL gives what DuckDB gives on the smallest tables."""

import glob
import os

import duckdb
import pytest

from lavra.llm import queries as entry
from tests.test_oracle import rows


@pytest.fixture(scope="module")
def duck(small):
    con = duckdb.connect()
    for f in glob.glob(f"{small}/*.parquet"):
        con.sql(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    return con


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_like_duckdb(spark, small, duck, name):
    got, want = entry.queries()[name](spark, small).toPandas(), duck.sql(entry.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    columns = sorted(got.columns)
    assert rows(got, columns) == rows(want, columns)
