"""Every registered query against its SQL counterpart on whole tables."""

import glob
import math
import os

import duckdb
import pytest

import __spark_entry__ as entry_module
from signalbarn.plans.queries import QUERIES as LIBRARY
from tests.conftest import SF_SMALL

# The corpus operators have tests of their own.
QUERIES = {name: query for name, query in entry_module.queries().items() if name in LIBRARY}
SQL = {name: sql for name, sql in entry_module.oracle_sql().items() if name in LIBRARY}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.sql("SET TimeZone='UTC'")
    for path in glob.glob(f"{SF_SMALL}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9)
    return value


def rows_of(rows):
    return sorted((tuple(plain(v) for v in r) for r in rows), key=repr)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_SMALL)
    columns = sorted(df.columns)
    expected = duck.sql(SQL[name])
    assert columns == sorted(expected.columns)
    quoted = ", ".join(f'"{c}"' for c in columns)
    want = rows_of(duck.sql(f"SELECT {quoted} FROM ({SQL[name]})").fetchall())
    got = rows_of(df.select(*[f"`{c}`" for c in columns]).collect())
    assert len(got) == len(want)
    assert got == want


def test_entry(spark):
    rows = entry_module.entry(spark).collect()
    assert len(rows) == 5
    times = [r.TimestampNanos for r in rows]
    assert times == sorted(times)
    assert rows[0].OffsetNanos == 0
