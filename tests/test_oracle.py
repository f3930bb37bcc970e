"""Every registered query with an SQL twin must agree with DuckDB on the
small tables (row count, column names, values)."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from skydrift.sources.tables import TABLES, table_path
from tests.conftest import SMALL

ORACLES = E.oracle_sql()


def _norm(v):
    if v is None:
        return None
    if hasattr(v, "item"):
        v = v.item()
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    try:
        from decimal import Decimal
        if isinstance(v, Decimal):
            return round(float(v), 6)
    except ImportError:
        pass
    return v


def _key(t):
    return tuple((x is None, str(type(x)), str(x)) for x in t)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(SMALL, t)}')")
    return con


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, duck, name):
    sdf = E.queries()[name](spark, SMALL)
    cols = sorted(sdf.columns)
    srows = sorted((tuple(_norm(r[c]) for c in cols) for r in sdf.collect()), key=_key)
    res = duck.execute(ORACLES[name])
    dcols = [d[0] for d in res.description]
    assert sorted(dcols) == cols
    idx = [dcols.index(c) for c in cols]
    drows = sorted((tuple(_norm(r[i]) for i in idx) for r in res.fetchall()), key=_key)
    assert len(srows) == len(drows)
    for a, b in zip(srows, drows):
        for x, y in zip(a, b):
            if isinstance(x, (int, float)) and isinstance(y, (int, float)):
                assert abs(x - y) <= 1e-6 * max(1.0, abs(x), abs(y)), (name, a, b)
            else:
                assert str(x) == str(y), (name, a, b)


def test_every_query_has_a_callable():
    qs = E.queries()
    assert set(ORACLES) <= set(qs)
    assert len(qs) >= 90


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "delay_rate" in df.columns
