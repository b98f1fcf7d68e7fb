"""Every registered query of the core against its SQL on the smallest data."""

import math
import os

import pytest

from tarkaloom.plans import catalog

DATA = os.environ.get("SMALL_DATA", "/root/testdata/sf0.001")
duckdb = pytest.importorskip("duckdb")
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")


def norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 5) + 0.0
    return v


def same(spark, con, query, sql):
    df = query(spark, DATA)
    cols = sorted(df.columns)
    got = sorted((tuple(norm(r[c]) for c in cols) for r in df.collect()), key=repr)
    res = con.execute(sql)
    names = [d[0] for d in res.description]
    assert sorted(names) == cols
    want = sorted((tuple(norm(float(r[names.index(c)])) if type(r[names.index(c)]).__name__ == "Decimal" else norm(r[names.index(c)]) for c in cols) for r in res.fetchall()), key=repr)
    assert got == want


@pytest.fixture(scope="session")
def con():
    c = duckdb.connect()
    c.execute("set timezone='UTC'")
    for f in os.listdir(DATA):
        if f.endswith(".parquet"):
            c.execute(f"create view {f[:-8]} as select * from '{DATA}/{f}'")
    return c


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_query_equals_sql(spark, con, name):
    same(spark, con, catalog.queries()[name], catalog.oracle_sql()[name])


def test_all_sql_belongs_to_a_query():
    assert set(catalog.oracle_sql()) <= set(catalog.queries())
