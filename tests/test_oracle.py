"""Every query with SQL gives what DuckDB gives on the smallest tables; every query runs."""

import glob
import math
import os

import duckdb
import pytest

import __spark_entry__ as entry

DATA = os.environ.get("LODEGRAPH_TEST_DATA", "/root/testdata/sf0.001")
NAMES = sorted(k for k in entry.queries() if not k.startswith("p") or k in ("p5_found", "p5_common", "p6_found", "p6_report"))
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables here")


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else float(f"{v:.9g}") + 0.0
    if isinstance(v, (list, tuple)):
        return tuple(map(plain, v))
    return v


@pytest.fixture(scope="module")
def db():
    c = duckdb.connect()
    for f in glob.glob(f"{DATA}/*.parquet"):
        c.execute(f"create view {os.path.basename(f)[:-8]} as select * from read_parquet('{f}')")
    return c


def compare(spark, db, name):
    df = entry.queries()[name](spark, DATA)
    cols = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in cols) for r in df.collect()), key=repr)
    sql = entry.oracle_sql().get(name)
    if sql:
        r = db.execute(sql)
        names = [x[0] for x in r.description]
        assert sorted(names) == cols
        assert got == sorted((tuple(plain(x[names.index(c)]) for c in cols) for x in r.fetchall()), key=repr)


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, db, name):
    compare(spark, db, name)


def test_entry(spark):
    assert entry.entry(spark).count() >= 0
