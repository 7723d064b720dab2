"""Every registered query against its DuckDB formulation (sf0.001)."""

import math
import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as se

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return "<null>"
    if isinstance(v, float):
        return "<null>" if math.isnan(v) else f"{v:.9g}"
    if hasattr(v, "item"):
        return _norm(v.item())
    return str(v)


def _canon(df):
    cols = sorted(df.columns)
    return cols, sorted(tuple(_norm(x) for x in rec) for rec in df[cols].itertuples(index=False, name=None))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(se.queries()))
def test_query_matches_oracle(spark, con, name):
    got = se.queries()[name](spark, SF).toPandas()
    sql = se.oracle_sql().get(name)
    if sql is None:
        assert len(got.columns) > 0
        return
    exp = con.execute(sql).df()
    assert _canon(got) == _canon(exp)


def test_entry_runs(spark):
    df = se.entry(spark)
    assert df.count() > 0
