"""Every registered query against its DuckDB oracle on the smallest scale
factor (the driver runs the same comparison at sf0.01)."""

import os

import duckdb
import pytest

from keepsake.registry import oracle_sql, queries
from tools.oracle_check import TABLES, normalise

SF = "/root/testdata/sf0.001"
NAMES = sorted(queries())


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_entry_runs(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    assert df.count() >= 0 and "retained" in df.columns
    assert set(e.oracle_sql()) <= set(e.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    got = queries()[name](spark, SF).toPandas()
    sql = oracle_sql().get(name)
    if sql is None:
        return
    want = con.execute(sql).df()
    assert sorted(got.columns) == sorted(want.columns)
    a, b = normalise(got), normalise(want)
    assert len(a) == len(b)
    assert a.equals(b)
