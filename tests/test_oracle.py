"""Every query with SQL equals DuckDB on the smallest tables."""

import os

import duckdb
import pandas as pd
import pytest

from spanloom.operators import ordering
from spanloom.plans import registry

NAMES = sorted(registry.queries())
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.execute(f"create view {f.split('.')[0]} as select * from '{SF}/{f}'")
    return con


def plain(v):
    if v is None or v is pd.NA or (isinstance(v, float) and v != v):
        return "null"
    if isinstance(v, bool) or type(v).__name__ == "bool_":
        return str(bool(v))
    if isinstance(v, float):
        return f"{v:.6f}"
    return str(int(v)) if type(v).__name__.startswith("int") else str(v)


def rows(df, floats):
    df = df[sorted(df.columns)]
    return sorted(tuple(f"{float(v):.6f}" if c in floats and plain(v) != "null" else plain(v) for c, v in zip(df.columns, r)) for r in df.itertuples(index=False))


def check(spark, duck, name):
    got = registry.queries()[name](spark, SF).toPandas()
    if name not in registry.oracle_sql():
        assert len(got) > 0
        return
    want = duck.execute(registry.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    floats = {c for c in got.columns if str(got[c].dtype).startswith("float") or str(want[c].dtype).startswith("float")}
    assert rows(got, floats) == rows(want, floats)


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, duck, name):
    check(spark, duck, name)


ORDERED = [n for n in NAMES if n.split("_")[0] in ("w3", "w4", "w5", "w6", "w10", "w11", "w12", "w13", "w15", "w16", "p8", "a24", "a29", "a35", "k4", "o2", "j22", "s5", "p14", "f11")]


@pytest.mark.parametrize("name", ORDERED)
def test_query_in_many_ranges(spark, duck, name, monkeypatch):
    """Order-dependent queries with their tables dealt over several ranges."""
    monkeypatch.setattr(ordering, "RANGE_ROWS", 300)
    check(spark, duck, name)
