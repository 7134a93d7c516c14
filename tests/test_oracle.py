"""Every query with SQL gives what DuckDB gives on the smallest tables."""

import glob
import os
from collections import Counter

import duckdb
import numpy as np
import pytest

import __spark_entry__ as entry
from lavra import catalog


def rows(df, columns):
    out = []
    for r in df[columns].itertuples(index=False):
        row = []
        for v in r:
            if v is None or isinstance(v, float) and v != v or str(v) in ("NaT", "<NA>"):
                row.append(None)
            elif isinstance(v, (float, np.floating)) or type(v).__name__ == "Decimal":
                row.append(f"{float(v):.6g}")
            elif isinstance(v, (int, np.integer)) and not isinstance(v, bool):
                row.append(f"{float(v):.6g}" if abs(int(v)) < 1e6 else str(int(v)))
            else:
                row.append(str(v))
        out.append(tuple(row))
    return Counter(out)


@pytest.fixture(scope="module")
def duck(small):
    con = duckdb.connect()
    for f in glob.glob(f"{small}/*.parquet"):
        con.sql(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    return con


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_like_duckdb(spark, small, duck, name):
    got, want = catalog.queries()[name](spark, small).toPandas(), duck.sql(catalog.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    columns = sorted(got.columns)
    assert rows(got, columns) == rows(want, columns)


def test_every_reference_query_has_sql():
    assert set(catalog.queries()) - set(catalog.oracle_sql()) == set()


def test_entry(spark):
    assert entry.entry(spark).count() > 0
