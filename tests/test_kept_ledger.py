"""The ledger that is updated in place against the batch operators over the same requests."""

import random
from datetime import timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from test_health import LOG, START, request_log
from test_streaming import feed, same, source

from postlake.operators import health
from postlake.streaming import kept_history, stream_kept_ledger, stream_kept_states, update_ledger

pytestmark = pytest.mark.usefixtures("many_partitions")
LAYOUT = {"time_slice": timedelta(seconds=60), "buckets": 4, "deltas": 2}
WHOLE = ("n", "n_ok", "lead_fails", "trail_fails", "max_streak", "any_dead", "first_ts", "last_ts", "last_ok_ts")


def written(folder, number):
    """Buckets that a batch wrote segments of."""
    return {p.name for p in Path(folder, "segments", f"batch={number}").glob("bucket=*")}


def contents(folder):
    return {str(p) for p in Path(folder).glob("segments/*/*")} | {str(p) for p in Path(folder).glob("outcomes/*/*")}


def agrees(spark, folder, rows, number=None):
    log = spark.createDataFrame(rows, LOG)
    return same(
        kept_history(spark, folder, number).select("endpoint", *WHOLE), health.endpoint_history(log).select("endpoint", *WHOLE)
    )


@pytest.mark.parametrize("order", ["shuffled", "sorted", "reversed"])
def test_any_order(spark, tmp_path, order):
    """Whole segments are those of the batch run after the last batch and the one before, whichever way rows come."""
    folder, rows = str(tmp_path), request_log(7, 600)
    if order != "shuffled":
        rows.sort(key=lambda r: (r[1], r[2]), reverse=order == "reversed")
    for number in range(3):
        update_ledger(spark.createDataFrame(rows[number * 200 : (number + 1) * 200], LOG), folder, number, **LAYOUT)
    assert agrees(spark, folder, rows)
    assert agrees(spark, folder, rows[:400], 1)


def test_only_touched_buckets_are_written(spark, tmp_path):
    """A batch on one endpoint writes one bucket, and of that the changed segments until its deltas are merged."""
    folder, rows = str(tmp_path), sorted(request_log(3, 800), key=lambda r: r[1])
    update_ledger(spark.createDataFrame(rows, LOG), folder, 0, **LAYOUT)
    assert len(written(folder, 0)) == 4
    for number in range(1, 4):
        row = ("hot", START + timedelta(hours=number), 10_000 + number, False, 500)
        rows.append(row)
        update_ledger(spark.createDataFrame([row], LOG), folder, number, **LAYOUT)
        assert len(written(folder, number)) == 1
        merged = number == 2  # it had two deltas
        assert (spark.read.parquet(f"{folder}/segments/batch={number}").count() > 1) == merged
    assert agrees(spark, folder, rows)
    bucket = written(folder, 3).pop()
    assert not Path(folder, "segments/batch=0", bucket).exists() and len(written(folder, 0)) == 3


def test_late_rows_open_their_segment_again(spark, tmp_path):
    """A late row writes its own segment only; a late success cuts the streak that it falls into."""
    folder = str(tmp_path)
    rows = [("a", START + timedelta(minutes=m, seconds=s), m * 60 + s, False, 500) for m in range(4) for s in range(0, 60, 10)]
    update_ledger(spark.createDataFrame(rows, LOG), folder, 0, **LAYOUT)
    late = ("a", START + timedelta(minutes=1, seconds=25), 9_999, True, 200)
    update_ledger(spark.createDataFrame([late], LOG), folder, 1, **LAYOUT)
    assert spark.read.parquet(f"{folder}/segments/batch=1").count() == 1
    got = kept_history(spark, folder).first()
    assert (got["n"], got["lead_fails"], got["trail_fails"], got["max_streak"]) == (25, 9, 15, 15)


def test_replay_changes_nothing(spark, tmp_path):
    """A batch that is run again, whole or after it was cut short before its version, gives the same tables."""
    folder, rows = str(tmp_path), request_log(9, 300)
    parts = [rows[i : i + 100] for i in range(0, 300, 100)]
    for number, part in enumerate(parts):
        frame = spark.createDataFrame(part, LOG)
        update_ledger(frame, folder, number, **LAYOUT)
        once, places = sorted(map(str, kept_history(spark, folder).collect())), contents(folder)
        update_ledger(frame, folder, number, **LAYOUT)
        assert sorted(map(str, kept_history(spark, folder).collect())) == once
        assert contents(folder) == places
    assert agrees(spark, folder, rows)


def test_cut_short_before_the_version(spark, tmp_path, monkeypatch):
    """Without its version a batch has no effect, and reading goes on with the one before."""
    folder, rows = str(tmp_path), request_log(11, 300)
    update_ledger(spark.createDataFrame(rows[:200], LOG), folder, 0, **LAYOUT)
    frame, session = spark.createDataFrame(rows[200:], LOG), type(spark)
    made = session.createDataFrame

    def fails(self, data, schema=None, **kwargs):
        if schema is not None and "stale" in str(schema):
            raise OSError("lost")
        return made(self, data, schema, **kwargs)

    with monkeypatch.context() as patch:
        patch.setattr(session, "createDataFrame", fails)
        with pytest.raises(OSError):
            update_ledger(frame, folder, 1, **LAYOUT)
    assert agrees(spark, folder, rows[:200])
    update_ledger(frame, folder, 1, **LAYOUT)
    assert agrees(spark, folder, rows)


def test_odd_rows(spark, tmp_path):
    """No endpoint, no time, no outcome, ties and repeated rows count as in batch runs; empty batches change nothing."""
    folder, rng = str(tmp_path), random.Random(2)
    base = [
        (None, START, 1, False, 500), (None, START, 2, True, 200), ("a", None, 3, False, 404), ("a", None, 1, True, 200),
        ("a", START, None, False, 500), ("a", START, 4, None, None), ("b", START, 5, False, 500), ("b", START, 5, False, 500),
        ("", START + timedelta(days=400), 6, False, None),
    ]
    rows = base * 2
    rng.shuffle(rows)
    rows = [(e, t, None if n is None else n + 10 * i, ok, s) for i, (e, t, n, ok, s) in enumerate(rows)]
    for number, part in enumerate([rows[:0], rows[:7], rows[7:8], rows[8:8], rows[8:]]):
        frame = spark.createDataFrame(part, LOG).withColumns({"seq": F.lit("x"), "bucket": F.lit(-5), "n": F.lit(0)})
        update_ledger(frame, folder, number, **LAYOUT)
        seen = rows[: (0, 7, 8, 8, len(rows))[number]]
        assert agrees(spark, folder, seen)


def test_layout_is_fixed(spark, tmp_path):
    frame = spark.createDataFrame(request_log(1, 10), LOG)
    update_ledger(frame, str(tmp_path), 0, **LAYOUT)
    with pytest.raises(ValueError, match="buckets or time slices"):
        update_ledger(frame, str(tmp_path), 1, **LAYOUT | {"buckets": 9})


def test_streams_over_restarts(spark, tmp_path):
    inbox, work, rows = str(tmp_path / "in"), str(tmp_path / "work"), request_log(5, 600)
    rules = {"cooldown_base": 60, "dead_after": 4}
    for i in range(4):
        feed(spark, inbox, rows[i * 150 : (i + 1) * 150], LOG)
        if i % 2:
            log = spark.createDataFrame(rows[: (i + 1) * 150], LOG)
            assert same(stream_kept_ledger(source(spark, inbox, LOG), work, **LAYOUT), health.health_ledger(log))
    states = stream_kept_states(source(spark, inbox, LOG), work, layout=LAYOUT, **rules)
    assert same(states, health.pool_state(spark.createDataFrame(rows, LOG), **rules))


def test_small_batches_take_few_tasks(spark, tmp_path):
    """A batch of few rows runs few tasks, however many partitions a shuffle has."""
    folder, rows = str(tmp_path), sorted(request_log(13, 300), key=lambda r: r[1])
    context, tracker = spark.sparkContext, spark.sparkContext.statusTracker()
    names = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")
    before = [spark.conf.get(n) for n in names]
    spark.conf.set(names[0], "64")
    spark.conf.set(names[1], "true")
    try:
        for number in range(2):
            context.setJobGroup(f"batch-{number}", "fold")
            update_ledger(spark.createDataFrame(rows[number * 150 : (number + 1) * 150], LOG), folder, number, **LAYOUT)
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
        for name, value in zip(names, before, strict=True):
            spark.conf.set(name, value)
    stages = {i for job in tracker.getJobIdsForGroup("batch-1") for i in tracker.getJobInfo(job).stageIds}
    sizes = [i.numCompletedTasks for i in map(tracker.getStageInfo, stages) if i is not None]
    assert sizes and max(sizes) < 64
    assert agrees(spark, folder, rows)
