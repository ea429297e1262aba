"""Every query of the package that has SQL gives what DuckDB gives on the smallest tables; every other one runs."""

import glob
import math
import os

import duckdb
import pytest

from lodegraph.llm import queries

DATA = os.environ.get("LODEGRAPH_TEST_DATA", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables here")


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else float(f"{v:.9g}") + 0.0
    return tuple(map(plain, v)) if isinstance(v, (list, tuple)) else v


@pytest.fixture(scope="module")
def db():
    c = duckdb.connect()
    for f in glob.glob(f"{DATA}/*.parquet"):
        c.execute(f"create view {os.path.basename(f)[:-8]} as select * from read_parquet('{f}')")
    return c


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, db, name):
    df = queries.QUERIES[name](spark, DATA)
    cols = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in cols) for r in df.collect()), key=repr)
    if sql := queries.SQL.get(name):
        r = db.execute(sql)
        names = [x[0] for x in r.description]
        assert sorted(names) == cols
        assert got == sorted((tuple(plain(x[names.index(c)]) for c in cols) for x in r.fetchall()), key=repr)
