"""Every registered query against its SQL on the smallest tables."""

import pathlib

import duckdb
import pytest

import __spark_entry__ as entry
from brightwell.plans.registry import CHECKS, QUERIES
from tools.check import same_type, table

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connected()


def connected():
    connection = duckdb.connect()
    connection.sql("SET TimeZone = 'UTC'")
    for path in pathlib.Path(FOLDER).glob("*.parquet"):
        connection.sql(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


@pytest.mark.parametrize("name", sorted(CHECKS))
def test_query_equals_sql(spark, duck, name):
    compare(QUERIES[name](spark, FOLDER), duck.sql(CHECKS[name]))


def compare(df, wanted):
    got = df.toArrow()
    assert table(got.column_names, zip(*[c.to_pylist() for c in got.columns])) == table(
        wanted.columns, wanted.fetchall())
    types = dict(zip(wanted.columns, map(str, wanted.types)))
    assert [f.name for f in df.schema if not same_type(f.dataType.simpleString(), types[f.name])] == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(CHECKS)))
def test_query_without_sql_gives_rows(spark, name):
    assert QUERIES[name](spark, FOLDER).count() > 0


def test_names_agree(spark):
    assert set(CHECKS) <= set(QUERIES) <= set(entry.queries()) and set(CHECKS) <= set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).columns == QUERIES["tumbling_hourly"](spark, FOLDER).columns
