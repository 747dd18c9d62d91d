"""Every registered query over tables without rows."""

import pytest
from check_oracle import TABLES, database

from postlake.plans.oracle import ORACLE
from postlake.plans.registry import QUERIES

FOLDER = "/root/testdata/sf0.001"
# Summaries have a row, and statistics one per query that was asked.
ROWS = {"run_manifest": 1, "enrichment_summary": 1, "pool_stats": 1, "query_stats": 4, "search_new_in_order": 4}


@pytest.fixture(scope="module")
def empty(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("empty"))
    for name in TABLES:
        spark.read.parquet(f"{FOLDER}/{name}.parquet").limit(0).write.parquet(f"{folder}/{name}.parquet")
    return folder


@pytest.fixture(scope="module")
def db():
    return database(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_rows(spark, db, empty, name):
    found = QUERIES[name](spark, empty)
    assert sorted(found.columns) == sorted(d[0] for d in db.execute(f"SELECT * FROM ({ORACLE[name]}) LIMIT 0").description)
    assert found.count() == ROWS.get(name, 0)
