"""Every registered query against its SQL on the smallest tables."""

import pytest
from check_oracle import database, rows_of_spark, rows_of_sql

from __spark_entry__ import entry, oracle_sql, queries
from postlake.plans.registry import QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    return database(FOLDER)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_same_rows(spark, db, name):
    names, rows = rows_of_spark(queries()[name](spark, FOLDER))
    want_names, want = rows_of_sql(db, oracle_sql()[name])
    assert names == want_names
    assert rows == want


def test_every_query_has_sql():
    assert set(QUERIES) <= set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert entry(spark).columns == ["term", "total", "unique_cnt"]
