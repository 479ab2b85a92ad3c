"""Each query of the core against its SQL, on the smallest tables."""

import glob
import math
import os
from collections import Counter

import pytest

from folioflow.__main__ import PLANS

duckdb = pytest.importorskip("duckdb")
DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="the driver's tables are not here")


def load():
    import importlib

    mods = [importlib.import_module(f"folioflow.plans.{p}") for p in PLANS]
    return {n: q for m in mods for n, q in m.QUERIES.items()}, {n: s for m in mods for n, s in getattr(m, "ORACLE", {}).items()}


QUERIES, ORACLE = load()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("SET timezone = 'UTC'")
    for path in glob.glob(f"{DATA}/*.parquet"):
        c.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return c


def value(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    return v.replace(tzinfo=None) if hasattr(v, "tzinfo") else v


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_like_sql(spark, con, name):
    df = QUERIES[name](spark, DATA)
    got = Counter(tuple(map(value, r)) for r in df.select(*sorted(df.columns)).collect())
    result = con.execute(ORACLE[name])
    cols = [d[0] for d in result.description]
    assert sorted(cols) == sorted(df.columns)
    order = [cols.index(c) for c in sorted(cols)]
    assert got == Counter(tuple(value(r[i]) for i in order) for r in result.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_runs_without_sql(spark, name):
    assert QUERIES[name](spark, DATA).count() >= 0
