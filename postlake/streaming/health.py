"""Endpoint health kept up to date from a stream of request outcomes.

Each micro-batch turns into segments that are combined with the stored history, one row per
endpoint. Streaks depend on order, so rows newer than the watermark wait in a pending table until
nothing earlier can arrive any more. Batch N reads version N-1 and writes version N, so replaying a
batch after a failure gives the same tables; the version before those two is removed. Rows behind the
watermark come too late to be placed in a streak. They are kept in a ``late`` table and counted when
the history is read: numbers that do not depend on order are exact, and so are current streaks unless
a success came late; endpoints with such rows are flagged.

With rules given, each batch also writes what changed up to its watermark: the watermark is the clock by which
cool-downs end, so an endpoint recovers in the first batch whose watermark passes that moment, without any request.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postlake.functions import classify_failure
from postlake.operators.health import combine_segments, endpoint_segments, ledger_of, states_of
from postlake.operators.state_changes import state_changes
from postlake.session import remove
from postlake.streaming.running import drain

_LOG_FIELDS = ("endpoint", "ts", "event_id", "ok", "status")
_NO_MARK = -(10**15)


def _version(folder: str, table: str, batch: int) -> str:
    return f"{folder}/{table}/batch={batch}"


def _with_settled(history: DataFrame | None, rows: DataFrame) -> DataFrame:
    segments = endpoint_segments(rows)
    return combine_segments(segments if history is None else history.unionByName(segments))


def stream_endpoint_history(log: DataFrame, folder: str, delay: timedelta, rules: dict | None = None) -> None:
    """Fold the request outcomes at hand into the history in ``folder``.

    With ``rules`` (those of ``pool_state``, maybe none of them) each batch writes the changes of states too; a folder
    has them from its first batch on or never.
    """
    slack = delay // timedelta(microseconds=1)

    def fold(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        read = lambda table: spark.read.parquet(_version(folder, table, number - 1))
        write = lambda frame, table: frame.write.mode("overwrite").parquet(_version(folder, table, number))
        upto = lambda mark: F.col("ts") <= F.timestamp_micros(F.lit(mark))
        rows = batch.select(*_LOG_FIELDS).persist()
        try:
            # Marks are micros; an instant before all data stands for "no watermark yet".
            before = read("mark").first()["mark"] if number else _NO_MARK
            newest = rows.agg(F.max(F.unix_micros("ts"))).first()[0]
            mark = before if newest is None else max(before, newest - slack)
            write(rows.filter(upto(before)), "late")
            history = read("history") if number else None
            waiting = rows.filter(~upto(before))
            if number:
                waiting = read("pending").unionByName(waiting)
            settled = waiting.filter(upto(mark))
            write(_with_settled(history, settled), "history")
            if rules is not None:
                moment = lambda micros: F.timestamp_micros(F.lit(micros))
                known = {"history": history, "after": moment(before)} if number else {}
                write(state_changes(settled, **rules, upto=moment(mark), **known), "changes")
            write(waiting.filter(~upto(mark)), "pending")
            write(spark.range(1).select(F.lit(mark).cast("bigint").alias("mark")), "mark")
        finally:
            rows.unpersist()
        for table in ("history", "pending", "mark") if number > 1 else ():
            remove(spark, _version(folder, table, number - 2))

    drain(log, fold, folder)


def history_so_far(spark: SparkSession, folder: str) -> DataFrame:
    """Combined history of everything received, waiting and late rows included.

    ``has_late`` flags endpoints with rows that came behind the watermark. A late success hides how many
    failures followed it, so ``trail_fails`` is then an upper bound; ``max_streak`` of a flagged endpoint
    is a lower bound.
    """
    last = spark.read.parquet(f"{folder}/mark").agg(F.max("batch")).first()[0]
    settled = spark.read.parquet(_version(folder, "history", last))
    history = _with_settled(settled, spark.read.parquet(_version(folder, "pending", last)))
    return _with_late(history, spark.read.parquet(f"{folder}/late").select(*_LOG_FIELDS))


def _with_late(history: DataFrame, late: DataFrame) -> DataFrame:
    """Add late rows to their endpoints' history; there are few, so they are summed up per endpoint."""
    told = late.groupBy("endpoint").agg(F.max(F.when(F.col("ok"), F.col("ts"))).alias("_ok"))
    known = history.select("endpoint", "last_ok_ts")
    last_ok = told.join(known, "endpoint", "left").select(
        "endpoint", F.greatest("last_ok_ts", "_ok").alias("_last_ok")
    )
    trailing = ~F.col("ok") & F.coalesce(F.col("ts") > F.col("_last_ok"), F.lit(True))
    dead = ~F.col("ok") & (classify_failure(F.col("status")) == "dead")
    sums = late.join(last_ok, "endpoint").groupBy("endpoint").agg(
        F.count("*").alias("_n"), F.count_if("ok").alias("_n_ok"), F.min("ts").alias("_first"), F.max("ts").alias("_last"),
        F.max("_last_ok").alias("_last_ok"), F.max(dead).alias("_dead"), F.count_if(trailing).alias("_trailing"),
    )
    zero, no = F.lit(0).cast("bigint"), F.lit(False)
    total = lambda a, b: F.coalesce(a, zero) + F.coalesce(b, zero)
    trail = total("trail_fails", "_trailing")
    return history.join(sums, "endpoint", "full").select(
        "endpoint", "seq", total("n", "_n").alias("n"), total("n_ok", "_n_ok").alias("n_ok"),
        F.coalesce("lead_fails", "_trailing").alias("lead_fails"), trail.alias("trail_fails"),
        F.greatest(F.coalesce("max_streak", zero), trail).alias("max_streak"),
        (F.coalesce("any_dead", no) | F.coalesce("_dead", no)).alias("any_dead"),
        F.least("first_ts", "_first").alias("first_ts"), F.greatest("last_ts", "_last").alias("last_ts"),
        F.greatest("last_ok_ts", "_last_ok").alias("last_ok_ts"), F.col("_n").isNotNull().alias("has_late"),
    )


def _flagged(frame: DataFrame, history: DataFrame) -> DataFrame:
    return frame.join(history.select("endpoint", "has_late"), "endpoint")


def stream_health_ledger(log: DataFrame, folder: str, delay: timedelta) -> DataFrame:
    """The ledger with ``has_late``, which flags endpoints whose streaks may not be exact."""
    stream_endpoint_history(log, folder, delay)
    history = history_so_far(log.sparkSession, folder)
    return _flagged(ledger_of(history), history)


def stream_state_changes(log: DataFrame, folder: str, delay: timedelta, **rules) -> DataFrame:
    """The changes of states up to the watermark so far; ``rules`` as in ``pool_state``.

    Replayed with ``states_at`` they give ``pool_state`` for any moment up to the watermark, but for rows that
    came behind it: what they would have changed is not told again.
    """
    stream_endpoint_history(log, folder, delay, rules)
    return log.sparkSession.read.parquet(f"{folder}/changes").drop("batch")


def stream_pool_state(
    log: DataFrame, folder: str, delay: timedelta, as_of: Column | None = None, **rules
) -> DataFrame:
    """States at ``as_of`` (the newest request when not given) with ``has_late``; ``rules`` as in ``pool_state``.

    The state of a flagged endpoint may depend on where its late rows belong.
    """
    stream_endpoint_history(log, folder, delay)
    history = history_so_far(log.sparkSession, folder)
    moment = history.agg(F.max("last_ts")).scalar() if as_of is None else as_of
    return _flagged(states_of(history, moment, **rules), history)
