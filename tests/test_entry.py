"""The driver contract: queries run on the smallest tables and agree with their SQL."""

import collections
import glob
import os

import pytest

import __spark_entry__ as entry

ROOT = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    if not os.path.isdir(ROOT):
        pytest.skip("no test tables here")
    con = duckdb.connect()
    con.execute("set timezone='UTC'")
    for f in glob.glob(f"{ROOT}/*.parquet"):
        con.execute(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    return con


def plain(v):
    return round(v, 9) if isinstance(v, float) else float(v) if type(v).__name__ == "Decimal" else v


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_against_sql(spark, duck, name):
    df, result = entry.queries()[name](spark, ROOT), duck.sql(entry.oracle_sql()[name])
    assert sorted(df.columns) == sorted(result.columns)
    order, names = sorted(df.columns), list(result.columns)
    got = collections.Counter(tuple(plain(r[c]) for c in order) for r in df.collect())
    expected = collections.Counter(tuple(plain(r[names.index(c)]) for c in order) for r in result.fetchall())
    assert got == expected


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(entry.oracle_sql())))
def test_runs(spark, duck, name):
    assert entry.queries()[name](spark, ROOT).count() >= 0


def test_flagship(spark, duck):
    assert entry.entry(spark).count() > 0
