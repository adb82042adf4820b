import glob
import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry
from vacantis.plans import catalogue


@pytest.fixture(scope="module")
def oracle(root):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for p in glob.glob(f"{root}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM read_parquet('{p}')")
    return con


def plain(df):
    df = df[sorted(df.columns)].copy()

    def cell(x):
        if x is None or x is pd.NaT or (isinstance(x, float) and x != x):
            return ""
        if hasattr(x, "year"):
            return str(pd.Timestamp(x))
        return repr(float(x)) if isinstance(x, (int, float)) and not isinstance(x, bool) else str(x)

    for c in df.columns:
        df[c] = df[c].map(cell)
    return df.sort_values(list(df.columns)).reset_index(drop=True)


@pytest.mark.parametrize("name", sorted(catalogue.queries()))
def test_query_against_its_sql(spark, root, oracle, name):
    got = catalogue.queries()[name](spark, root).toPandas()
    sql = catalogue.oracle_sql().get(name)
    if sql is None:
        assert list(got.columns)
        return
    want = oracle.execute(sql).df()
    assert sorted(got.columns) == sorted(want.columns)
    pd.testing.assert_frame_equal(plain(got), plain(want), check_dtype=False)


def test_entry(spark):
    assert entry.entry(spark).limit(1).count() == 1
