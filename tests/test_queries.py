"""Every registered query against its SQL in DuckDB, on the driver's smallest tables."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry_point

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="driver tables absent")

QUERIES, SQL = entry_point.queries(), entry_point.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def plain(rows, order):
    """Rows with columns in a fixed order, NaN-free, as a sorted list."""
    return sorted((tuple(r[i] for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    result = duck.execute(SQL[name])
    columns = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(columns)
    ours = plain(df.collect(), [df.columns.index(c) for c in sorted(columns)])
    theirs = plain(result.fetchall(), [columns.index(c) for c in sorted(columns)])
    assert len(ours) == len(theirs)
    assert ours == theirs


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_without_sql_runs(spark, name):
    df = QUERIES[name](spark, FOLDER)
    assert df.count() > 0
    for chance in [c for c in df.columns if c.startswith("probability")]:
        assert df.filter(f"{chance} NOT BETWEEN 0 AND 1").isEmpty()


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)
