"""Every query with a SQL check gives the same rows as DuckDB on the small tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from check import TABLES, digest

SF_DIR = "/root/testdata/sf0.001"
ORACLES = entry.oracle_sql()
QUERIES = entry.queries()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return con


def test_every_check_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    result = duck.execute(ORACLES[name])
    columns = [d[0] for d in result.description]
    expected = result.fetchall()
    rows = [tuple(r) for r in df.collect()]
    assert sorted(df.columns) == sorted(columns)
    assert len(rows) == len(expected)
    assert digest(df.columns, rows)[0] == digest(columns, expected)[0]


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs(spark, name):
    assert QUERIES[name](spark, SF_DIR).limit(1).count() == 1


def test_entry(spark):
    assert entry.entry(spark).limit(1).count() == 1
