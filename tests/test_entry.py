"""Every registered query against its SQL at the smallest scale factor."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry

DATA = Path("/root/testdata/sf0.001")
QUERIES, ORACLE = entry.queries(), entry.oracle_sql()
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="test tables are not here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in DATA.glob("*.parquet"):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    return con


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted([str(r[i]) for i in order] for r in data)


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, str(DATA))
    got = rows(df.columns, df.collect())
    assert got
    if name in ORACLE:
        want = duck.sql(ORACLE[name])
        assert sorted(want.columns) == sorted(df.columns)
        assert got == rows(want.columns, want.fetchall())


def test_entry(spark):
    first = entry.entry(spark).first()
    assert first.score >= 0 and first.slug
