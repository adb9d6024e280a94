"""Every query with SQL against DuckDB, on the smallest tables."""

import math
import os

import pytest

from claimscope.plans import catalogue

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events".split()


def normal(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.8g}")
    return v


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


@pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")
@pytest.mark.parametrize("name", sorted(catalogue.oracle_sql()))
def test_oracle(spark, duck, name):
    df = catalogue.queries()[name](spark, SF)
    rel = duck.sql(catalogue.oracle_sql()[name])
    cols = sorted(df.columns)
    assert sorted(rel.columns) == cols
    at = [rel.columns.index(c) for c in cols]
    key = lambda r: [(x is None, str(x)) for x in r]
    got = sorted((tuple(normal(r[c]) for c in cols) for r in df.collect()), key=key)
    want = sorted((tuple(normal(r[i]) for i in at) for r in rel.fetchall()), key=key)
    assert got == want
