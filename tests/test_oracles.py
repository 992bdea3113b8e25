"""Every query with SQL against DuckDB on the smallest tables; the others must run."""

import datetime
import decimal
import math
import os

import duckdb
import pytest

from plumbline.plans import registry
from plumbline.sources.tables import NAMES

DATA = "/root/testdata/sf0.001"
QUERIES, SQL = registry.queries(), registry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in NAMES:
        path = f"{DATA}/{name}.parquet"
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path + '/*.parquet' if os.path.isdir(path) else path}'")
    return con


def plain(v):
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6) + 0.0
    return v if not isinstance(v, datetime.datetime) else v.replace(tzinfo=None)


def ordered(rows):
    return sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, DATA)
    columns = sorted(df.columns)
    rows = ordered(tuple(plain(r[c]) for c in columns) for r in df.collect())
    if name not in SQL:
        assert rows
        return
    found = duck.execute(SQL[name])
    names = [c[0] for c in found.description]
    assert sorted(names) == columns
    assert rows == ordered(tuple(plain(r[names.index(c)]) for c in columns) for r in found.fetchall())
