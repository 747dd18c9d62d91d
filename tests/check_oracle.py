"""Compare registered queries with their SQL: ``python tests/check_oracle.py <sf_dir> [name ...]``."""

from __future__ import annotations

import math
import os
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def database(folder: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return db


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    return value


def rows_of_spark(df) -> tuple[list[str], list[tuple]]:
    names = sorted(df.columns)
    return names, sorted((tuple(_plain(v) for v in r) for r in df.select(*names).collect()), key=repr)


def rows_of_sql(db, sql: str) -> tuple[list[str], list[tuple]]:
    rel = db.execute(sql)
    names = [d[0] for d in rel.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    rows = [tuple(_plain(r[i]) for i in order) for r in rel.fetchall()]
    return [names[i] for i in order], sorted(rows, key=repr)


def main() -> int:
    from __spark_entry__ import oracle_sql, queries
    from postlake.session import build_session

    folder, chosen = sys.argv[1], sys.argv[2:]
    spark = build_session(
        "check", os.environ.get("CHECK_MASTER", "local[8]"), **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    db, wrong = database(folder), 0
    for name, query in queries().items():
        if chosen and name not in chosen:
            continue
        begun = time.time()
        try:
            names, rows = rows_of_spark(query(spark, folder))
        except Exception as error:  # report and go on with the others
            print(f"FAIL {name}: {str(error)[:1500]}")
            wrong += 1
            continue
        took = time.time() - begun
        if name not in oracle_sql():
            print(f"rows {name}: {len(rows)} ({took:.1f}s)")
            continue
        want_names, want = rows_of_sql(db, oracle_sql()[name])
        same = names == want_names and rows == want
        print(f"{'ok  ' if same else 'DIFF'} {name}: {len(rows)} rows, {len(want)} expected ({took:.1f}s)", flush=True)
        if not same:
            wrong += 1
            extra, lacking = set(map(repr, rows)) - set(map(repr, want)), set(map(repr, want)) - set(map(repr, rows))
            print("   columns", names, want_names)
            print("   extra  ", [x[:300] for x in sorted(extra)[:3]])
            print("   lacking", [x[:300] for x in sorted(lacking)[:3]])
    return 1 if wrong else 0


if __name__ == "__main__":
    raise SystemExit(main())
