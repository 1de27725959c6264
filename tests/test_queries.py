"""Every registered query against its SQL counterpart, on the whole tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry_point
from checks import queries as registered

SF_DIR = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    yield con
    con.close()


def ordered(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cells = [tuple(r[i] for i in order) for r in rows]
    return sorted(cells, key=lambda r: tuple((v is not None, v) for v in r))


@pytest.mark.parametrize("name", sorted(registered.queries()))
def test_query(spark, duck, name):
    df = entry_point.queries()[name](spark, SF_DIR)
    got = ordered(df.columns, [tuple(r) for r in df.collect()])
    result = duck.execute(entry_point.oracle_sql()[name])
    columns = [c[0] for c in result.description]
    expected = ordered(columns, result.fetchall())
    assert sorted(df.columns) == sorted(columns)
    assert len(got) == len(expected)
    assert got == expected
    assert got, "a query without result rows checks nothing"


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0
    assert set(registered.queries()) <= set(entry_point.oracle_sql()) <= set(entry_point.queries())
