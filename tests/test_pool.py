"""Endpoint lists and ledger upserts."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from postlake.functions import normalize_endpoint
from postlake.operators import pool

NOW = datetime(2024, 5, 1)
OLD = datetime(2024, 1, 1)
LEDGER = "endpoint string, last_ok timestamp, ok_streak bigint, fail_streak bigint"


def listed(spark, *endpoints):
    return spark.createDataFrame([(e, i) for i, e in enumerate(endpoints)], "endpoint string, pos bigint")


@pytest.mark.parametrize(
    "raw, clean",
    [
        (" h:1 ", "http://h:1"),
        ("https://h:1\n", "https://h:1"),
        ("HTTP://h", "http://HTTP://h"),
        ("\t   ", ""),
        ("\x1c h \x1f", "http://h"),
        ("", ""),
        ("a b", "http://a b"),
    ],
)
def test_normalize(spark, raw, clean):
    df = spark.createDataFrame([(raw,)], "line string")
    assert df.select(normalize_endpoint(F.col("line"))).first()[0] == clean


def test_merge_sources_keeps_first(spark):
    frames = [
        spark.createDataFrame([("b", 0), (" ", 1), ("a", 2)], "line string, pos bigint"),
        spark.createDataFrame([("http://a", 0), ("c", 1), ("c ", 2)], "line string, pos bigint"),
    ]
    got = sorted(map(tuple, pool.merge_sources(frames).collect()))
    assert got == [("http://a", 0, 2), ("http://b", 0, 0), ("http://c", 1, 1)]


def test_refresh_pool(spark):
    good, existing = listed(spark, "n1", "e2"), listed(spark, "e1", "e2", "e3")
    ranked = pool.refresh_pool(good, existing, 3).orderBy("rank").collect()
    assert [tuple(r) for r in ranked] == [("n1", 1, True), ("e2", 2, True), ("e1", 3, False)]


def test_refresh_without_good_keeps_the_pool(spark):
    nothing = listed(spark, "x").filter("false")
    kept = pool.refresh_pool(nothing, listed(spark, "e1", "e2", "e3"), 1).orderBy("rank").collect()
    assert [(r["endpoint"], r["rank"]) for r in kept] == [("e1", 1), ("e2", 2), ("e3", 3)]
    far = spark.range(0, 3000).selectExpr("concat('e', id) AS endpoint", "id * 7 AS pos")
    kept = pool.refresh_pool(nothing, far, 1).collect()
    assert sorted((r["rank"], r["endpoint"]) for r in kept) == sorted((i + 1, f"e{i}") for i in range(3000))


def test_ledger_upserts(spark):
    ledger = spark.createDataFrame([("a", OLD, 5, 2), ("b", OLD, 1, 0)], LEDGER)
    grown = pool.upsert_ledger(ledger, listed(spark, "b", "c", "c"), F.lit(NOW))
    assert sorted(map(tuple, grown.collect())) == [("a", OLD, 5, 2), ("b", OLD, 1, 0), ("c", NOW, 0, 0)]
    members = spark.createDataFrame([("a", True), ("c", None)], "endpoint string, tested boolean")
    tested = pool.refresh_ledger(ledger, members, F.lit(NOW))
    assert sorted(map(tuple, tested.collect())) == [("a", NOW, 6, 0), ("c", NOW, 0, 0)]
    every = pool.refresh_ledger(ledger, listed(spark, "a", "b"), F.lit(NOW), bump_untested=True)
    assert sorted(map(tuple, every.collect())) == [("a", NOW, 6, 0), ("b", NOW, 2, 0)]


def test_append_if_absent(spark):
    target = listed(spark, "a", "b")
    new = spark.createDataFrame([("b", 9), ("c", 8), ("c", 7)], "endpoint string, pos bigint")
    grown = pool.append_if_absent(target, new, "endpoint")
    assert sorted(map(tuple, grown.collect())) == [("a", 0), ("b", 1), ("c", 7)]
    assert pool.append_if_absent(grown, new, "endpoint").count() == 3
