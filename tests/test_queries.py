"""Every query with SQL gives the rows of the SQL on the smallest tables."""

import datetime as dt
import math
from pathlib import Path

import pytest

import __spark_entry__ as entry

DATA = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="the test tables aren't here")


@pytest.fixture(scope="session")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in DATA.glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def plain(v):
    if isinstance(v, dt.datetime) and v.tzinfo:
        v = v.astimezone(dt.timezone.utc).replace(tzinfo=None)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 9) + 0.0)
    return str([plain(x) for x in v]) if isinstance(v, (list, tuple)) else str(v)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_same_as_sql(spark, duck, name):
    df = entry.queries()[name](spark, str(DATA))
    order = sorted(df.columns)
    result = duck.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == order
    at = [columns.index(c) for c in order]
    assert sorted(tuple(plain(r[c]) for c in order) for r in df.collect()) == sorted(tuple(plain(r[i]) for i in at) for r in result.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_oracles_have_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())
