"""Every registered query of the training-data operators on the smallest tables."""

import pytest

import __spark_entry__ as entry
from tests.test_queries import FOLDER, compare, connected

QUERIES, CHECKS = entry.CORPUS_QUERIES, entry.CORPUS_CHECKS


@pytest.fixture(scope="module")
def duck():
    return connected()


@pytest.mark.parametrize("name", sorted(CHECKS))
def test_query_equals_sql(spark, duck, name):
    compare(QUERIES[name](spark, FOLDER), duck.sql(CHECKS[name]))


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(CHECKS)))
def test_query_without_sql_gives_rows(spark, name):
    assert QUERIES[name](spark, FOLDER).count() > 0
