"""Every registered query against its DuckDB oracle on the sf0.001 tables."""

import datetime as dt
import decimal
import math
import os

import duckdb
import pytest

from ledgerlens.plans.oracle import ORACLE
from ledgerlens.plans.registry import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("lineitem", "part", "orders", "customer", "supplier", "nation", "region"):
        c.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    return c


def norm(v):
    if isinstance(v, (decimal.Decimal, int)) and not isinstance(v, bool):
        return float(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    if isinstance(v, float) and math.isnan(v):
        return None
    return v


def rows(cols, it):
    return sorted((tuple(norm(r[c]) for c in cols) for r in it), key=repr)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_oracle(spark, con, name):
    sdf = QUERIES[name](spark, SF)
    cols = sorted(sdf.columns)
    got = rows(cols, [r.asDict() for r in sdf.collect()])
    res = con.execute(ORACLE[name])
    names = [d[0] for d in res.description]
    assert sorted(names) == cols
    want = rows(cols, [dict(zip(names, r)) for r in res.fetchall()])
    assert got == want


def test_entry_smoke(spark):
    import __spark_entry__ as E

    df = E.entry(spark)
    assert df.count() > 0
    assert len(df.columns) == 12
