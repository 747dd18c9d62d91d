"""Streams fed file by file against the batch operators."""

from datetime import timedelta

import pytest
from test_health import LOG, START, request_log

from postlake.operators import enrichment, health
from postlake.operators.state_changes import state_changes
from postlake.streaming import (
    drain_to_parquet,
    history_so_far,
    stream_dedup_posts,
    stream_endpoint_history,
    stream_enrich,
    stream_enrich_late,
    stream_health_ledger,
    stream_pool_state,
    stream_state_changes,
)

pytestmark = pytest.mark.usefixtures("many_partitions")


def feed(spark, folder, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)


def source(spark, folder, schema):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)


def same(left, right):
    return sorted(map(tuple, left.collect()), key=repr) == sorted(map(tuple, right.collect()), key=repr)


@pytest.fixture(scope="module")
def slices():
    rows = sorted(request_log(5, 800), key=lambda r: (r[1], r[2]))
    # Neighbouring slices overlap in time by up to 80 seconds.
    rows.sort(key=lambda r: r[1] + timedelta(seconds=(r[2] * 37) % 80))
    return [rows[i : i + 200] for i in range(0, 800, 200)]


def test_health_over_restarts(spark, tmp_path, slices):
    inbox, work, delay = str(tmp_path / "in"), str(tmp_path / "work"), timedelta(seconds=90)
    rules = {"cooldown_base": 60, "dead_after": 4}
    for i, rows in enumerate(slices):
        feed(spark, inbox, rows, LOG)
        if i % 2:  # two files, two micro-batches, then a new start of the query
            log = spark.createDataFrame([r for s in slices[: i + 1] for r in s], LOG)
            ledger = stream_health_ledger(source(spark, inbox, LOG), work, delay)
            assert same(ledger.drop("has_late"), health.health_ledger(log))
    log = spark.createDataFrame([r for s in slices for r in s], LOG)
    states = stream_pool_state(source(spark, inbox, LOG), work, delay, **rules)
    assert same(states.drop("has_late"), health.pool_state(log, **rules))
    assert states.filter("has_late").count() == 0
    assert spark.read.parquet(f"{work}/late").count() == 0
    last = spark.read.parquet(f"{work}/pending")
    assert 0 < last.filter("batch = 3").count() < 800


@pytest.mark.parametrize("base", [7, 200])
def test_changes_by_the_clock(spark, tmp_path, slices, base):
    """Over restarts, the changes are those of the batch run up to the watermark, recoveries without requests too."""
    inbox, work, delay = str(tmp_path / "in"), str(tmp_path / "work"), timedelta(seconds=90)
    rules = {"cooldown_base": base, "dead_after": 4}
    rows = []
    for i, part in enumerate([*slices, [("late clock", START + timedelta(hours=2), 10_000, True, 200)]]):
        feed(spark, inbox, part, LOG)
        rows += part
        if i != 1:  # the second and third file come in two micro-batches of one start
            changes = stream_state_changes(source(spark, inbox, LOG), work, delay, **rules)
            mark = max(r[1] for r in rows) - delay
            want = state_changes(spark.createDataFrame(rows, LOG), **rules)
            assert same(changes, want.filter(want["at"] <= mark))
    assert changes.filter("at > timestamp'2024-01-01 00:03:20' AND state = 'good' AND failures > 0").count() > 0
    assert spark.read.parquet(f"{work}/late").count() == 0


def test_late_rows_are_set_aside(spark, tmp_path):
    inbox, work = str(tmp_path / "in"), str(tmp_path / "work")
    feed(spark, inbox, [("a", START + timedelta(hours=1), 1, True, 200)], LOG)
    stream_endpoint_history(source(spark, inbox, LOG), work, timedelta(minutes=1))
    feed(spark, inbox, [("a", START, 0, False, 500), ("a", START + timedelta(hours=2), 2, False, 500)], LOG)
    stream_endpoint_history(source(spark, inbox, LOG), work, timedelta(minutes=1))
    assert [r["event_id"] for r in spark.read.parquet(f"{work}/late").collect()] == [0]
    row = history_so_far(spark, work).first()
    assert (row["n"], row["trail_fails"], row["has_late"]) == (3, 1, True)
    feed(spark, inbox, [("b", START + timedelta(hours=3), 3, True, 200)], LOG)
    for frame in (stream_health_ledger, stream_pool_state):
        flags = frame(source(spark, inbox, LOG), work, timedelta(minutes=1)).select("endpoint", "has_late").collect()
        assert sorted(map(tuple, flags)) == [("a", True), ("b", False)]


def test_late_rows_count(spark, tmp_path):
    """Slices out of order without any delay: what does not depend on order equals the batch run."""
    inbox, work = str(tmp_path / "in"), str(tmp_path / "work")
    rows = sorted(request_log(7, 600), key=lambda r: r[1])
    feed(spark, inbox, [r for r in rows[200:400] if r[0] != "h5"], LOG)
    stream_endpoint_history(source(spark, inbox, LOG), work, timedelta(0))
    feed(spark, inbox, [r for r in rows[:200] if r[0] != "h5"] + rows[400:], LOG)
    late_only = [("h5", START, 10_000, False, 404)]
    feed(spark, inbox, late_only, LOG)
    stream_endpoint_history(source(spark, inbox, LOG), work, timedelta(0))
    log = spark.createDataFrame([r for r in rows[:400] if r[0] != "h5"] + rows[400:] + late_only, LOG)
    facts = ["endpoint", "n", "n_ok", "any_dead", "first_ts", "last_ts", "last_ok_ts"]
    got, want = history_so_far(spark, work), health.endpoint_history(log)
    assert same(got.select(*facts), want.select(*facts))
    streaks = want.select("endpoint", want["trail_fails"].alias("exact"))
    assert got.join(streaks, "endpoint").filter("trail_fails < exact OR (NOT has_late AND trail_fails <> exact)").count() == 0
    assert {r["batch"] for r in spark.read.parquet(f"{work}/history").select("batch").distinct().collect()} == {1, 2}


@pytest.mark.parametrize("fan_out", [0, 3])
def test_dedup_posts(spark, tmp_path, fan_out):
    schema = "id string, permalink string, ts timestamp"
    at = lambda s: START + timedelta(seconds=s)
    inbox = str(tmp_path / "in")
    feed(spark, inbox, [("1", "/a/", at(0)), ("1", "/b/", at(1)), ("", "/c/", at(2)), ("", "", at(2))], schema)
    feed(spark, inbox, [("1", "/d/", at(3)), (None, "/c/", at(4)), ("2", "/e/", at(5)), ("2", "/e/", at(5))], schema)
    kept = stream_dedup_posts(source(spark, inbox, schema), "ts", "1 hour", fan_out)
    out = drain_to_parquet(kept, str(tmp_path / "work"))
    assert sorted(r["key"] for r in out.collect()) == ["/c/", "1", "2"]


def test_enrich_each_post_once(spark, tmp_path):
    schema = "id string, permalink string, created_utc double"
    inbox, work = str(tmp_path / "in"), str(tmp_path / "work")
    known = spark.createDataFrame([("/a/", "text", 1)], "permalink string, body string, n_comments bigint")
    feed(spark, inbox, [("1", "/a/", 1.0), ("2", "/x/", 2.0), ("2", "/x/", 3.0)], schema)
    feed(spark, inbox, [("1", "/a/", 9.0), ("3", "", 4.0)], schema)
    out = stream_enrich(source(spark, inbox, schema), known, work)
    posts = spark.createDataFrame([("1", "/a/", 1.0), ("2", "/x/", 2.0), ("3", "", 4.0)], schema)
    want = enrichment.enrich_posts(posts, known)
    assert same(out.select(*want.columns), want)
    feed(spark, inbox, [("3", "", 5.0), ("4", "/a/", 5.0)], schema)
    # Post 3 is known by its id again; an id alone tells posts apart, not where they link to.
    assert stream_enrich(source(spark, inbox, schema), known, work).count() == 4


@pytest.mark.parametrize("delay", [None, timedelta(seconds=10)])
def test_enrich_posts_without_id(spark, tmp_path, delay):
    schema = "id string, permalink string, created_utc double, at timestamp"
    at = lambda s: START + timedelta(seconds=s)
    inbox, work = str(tmp_path / "in"), str(tmp_path / "work")
    known = spark.createDataFrame([("/a/", "text", 1)], "permalink string, body string, n_comments bigint")
    rows = [
        [(None, "/a/", 1.0, at(0)), ("", "/b/", 1.0, at(0)), (None, "", 1.0, at(0)), ("", None, 1.0, at(0)), ("9", "", 1.0, at(0))],
        [(None, "/a/", 2.0, at(5)), (None, None, 2.0, at(5)), ("9", "", 2.0, at(5)), ("9", "/z/", 3.0, at(5))],
        [("5", "/a/", 3.0, at(100)), ("5", "/a/", 2.0, at(100))],
    ]
    for batch in rows:
        feed(spark, inbox, batch, schema)
    out = stream_enrich(source(spark, inbox, schema), known, work, time="at", delay=delay).collect()
    assert sorted((str(r["id"]), str(r["permalink"]), r["created_utc"], r["has_details"]) for r in out) == sorted([
        ("None", "/a/", 1.0, True), ("", "/b/", 1.0, False), ("None", "", 1.0, False), ("", "None", 1.0, False),
        ("9", "", 1.0, False), ("None", "None", 2.0, False), ("5", "/a/", 2.0, True),
    ])


@pytest.mark.parametrize("arrival", [("dp",), ("p", "pd")])
def test_details_in_any_order(spark, tmp_path, arrival):
    """Whenever details come, and over restarts, the result is that of the batch join."""
    schema = "id string, permalink string, created_utc double"
    known = "permalink string, body string, n_comments bigint"
    inbox, works = str(tmp_path / "in"), str(tmp_path / "work")
    posts = [
        [("1", "/a/", 1.0), ("2", "/b/", 2.0), ("2", "/b/", 3.0)],
        [("1", "/a/", 9.0), ("3", "", 4.0), (None, "/c/", 4.0), ("4", "/a/", 4.0)],
        [("5", "/never/", 5.0), ("", None, 5.0), (None, "/c/", 6.0), ("6", "/d/", 6.0)],
    ]
    details = [[("/d/", "text d", 0), ("/b/", "text b", 2)], [("/a/", "text a", 1), ("", "none", 1)], [("/c/", "", 3), ("/zzz/", "x", 1)]]
    for kind, shape in (("p", schema), ("d", known)):
        spark.createDataFrame([], shape).write.parquet(f"{inbox}/{kind}")
    left = {"p": list(posts), "d": list(details)}
    for step in arrival:
        for kind in step:
            if left[kind]:
                feed(spark, f"{inbox}/{kind}", left[kind].pop(0), schema if kind == "p" else known)
        out = stream_enrich_late(source(spark, f"{inbox}/p", schema), source(spark, f"{inbox}/d", known), works)
    for kind, shape in (("p", schema), ("d", known)):
        for rows in left[kind]:
            feed(spark, f"{inbox}/{kind}", rows, shape)
    out = stream_enrich_late(source(spark, f"{inbox}/p", schema), source(spark, f"{inbox}/d", known), works)
    kept = [r for r in posts[0][:2] + posts[1][1:] + posts[2] if r != (None, "/c/", 6.0)]
    unique = spark.createDataFrame([r for rows in details for r in rows if r[0]], known)
    want = enrichment.enrich_posts(spark.createDataFrame(kept, schema), unique)
    assert same(out.select(*want.columns), want)
