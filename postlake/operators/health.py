"""Endpoint health from a request log ``(endpoint, ts, event_id, ok, status)``.

Streaks need the order of an endpoint's requests, and one endpoint may own a large part of the log.
The log is therefore partitioned once, by endpoint and time slice, which splits a busy endpoint.
Every slice of an endpoint becomes one summary row, a *segment*. Segments of the same endpoint
combine in time order into one segment again, so the same code serves batch runs and micro-batches.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postlake.functions import classify_failure, cooldown_seconds
from postlake.functions.expressions import COOLDOWN_BASE_SECONDS, COOLDOWN_CAP, DEAD_AFTER_FAILURES

_ORDER = ["ts", "event_id"]
SLICE = timedelta(days=1)
# Before any slice: what earlier batches have settled.
SETTLED = -(1 << 62)


def _streak_columns(rows: Column, first_ok: Column, last_ok: Column) -> list[Column]:
    """Failures before the first and after the last success of ``rows`` requests."""
    return [
        F.coalesce(first_ok - 1, rows).alias("lead_fails"),
        (rows - F.coalesce(last_ok, F.lit(0))).alias("trail_fails"),
    ]


def endpoint_segments(log: DataFrame, time_slice: timedelta = SLICE) -> DataFrame:
    """Summaries of the requests of every endpoint in every ``time_slice``; their ``seq`` orders them.

    A slice of one endpoint is sorted in one task, so a log with very busy endpoints takes shorter ones.
    """
    width = time_slice // timedelta(microseconds=1)
    narrow = log.select(
        "endpoint", *_ORDER, "ok", (~F.col("ok") & (classify_failure(F.col("status")) == "dead")).alias("_dead")
    )
    sliced = narrow.withColumn("_slice", F.floor(F.unix_micros("ts") / width))
    stretch = Window.partitionBy("endpoint", "_slice").orderBy(*_ORDER)
    numbered = sliced.withColumn("_n", F.row_number().over(stretch).cast("bigint"))
    good = F.when(F.col("ok"), F.col("_n"))
    streak = F.when(F.col("ok"), F.lit(0)).otherwise(
        F.col("_n") - F.coalesce(F.max(good).over(stretch), F.lit(0))
    )
    summed = (
        numbered.withColumn("_streak", streak)
        .groupBy("endpoint", "_slice")
        .agg(
            F.count("*").alias("n"),
            F.count_if("ok").alias("n_ok"),
            F.min(good).alias("_first_ok"),
            F.max(good).alias("_last_ok"),
            F.max("_streak").alias("max_streak"),
            F.max("_dead").alias("any_dead"),
            F.min("ts").alias("first_ts"),
            F.max("ts").alias("last_ts"),
            F.max(F.when(F.col("ok"), F.col("ts"))).alias("last_ok_ts"),
        )
    )
    return summed.select(
        "endpoint", F.col("_slice").alias("seq"), "n", "n_ok",
        *_streak_columns(F.col("n"), F.col("_first_ok"), F.col("_last_ok")),
        "max_streak", "any_dead", "first_ts", "last_ts", "last_ok_ts",
    )


def combine_segments(segments: DataFrame, seq: int = SETTLED) -> DataFrame:
    """One segment per endpoint from its segments in ``seq`` order; the result carries ``seq``."""
    before = Window.partitionBy("endpoint").orderBy("seq")
    earlier = before.rowsBetween(Window.unboundedPreceding, -1)
    placed = segments.withColumn("_before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    has_ok = F.col("n_ok") > 0
    first_ok = F.when(has_ok, F.col("_before") + F.col("lead_fails") + 1)
    last_ok = F.when(has_ok, F.col("_before") + F.col("n") - F.col("trail_fails"))
    placed = placed.withColumn("_first_ok", first_ok).withColumn("_last_ok", last_ok)
    carried = F.col("_before") - F.coalesce(F.max("_last_ok").over(earlier), F.lit(0))
    return (
        placed.withColumn("_streak", F.greatest("max_streak", carried + F.col("lead_fails")))
        .groupBy("endpoint")
        .agg(
            F.sum("n").alias("n"),
            F.sum("n_ok").alias("n_ok"),
            F.min("_first_ok").alias("_first_ok"),
            F.max("_last_ok").alias("_last_ok"),
            F.max("_streak").alias("max_streak"),
            F.max("any_dead").alias("any_dead"),
            F.min("first_ts").alias("first_ts"),
            F.max("last_ts").alias("last_ts"),
            F.max("last_ok_ts").alias("last_ok_ts"),
        )
        .select(
            "endpoint", F.lit(seq).cast("bigint").alias("seq"), "n", "n_ok",
            *_streak_columns(F.col("n"), F.col("_first_ok"), F.col("_last_ok")),
            "max_streak", "any_dead", "first_ts", "last_ts", "last_ok_ts",
        )
    )


def endpoint_history(log: DataFrame, as_of: Column | None = None) -> DataFrame:
    """One segment per endpoint over the log, up to ``as_of`` when given."""
    if as_of is not None:
        log = log.filter(F.col("ts") <= as_of)
    return combine_segments(endpoint_segments(log))


def streaks_of(history: DataFrame) -> DataFrame:
    return history.select("endpoint", "max_streak", F.col("trail_fails").alias("cur_streak"))


def ledger_of(history: DataFrame) -> DataFrame:
    """``ok_streak`` counts all successes; ``fail_streak`` the failures since the last one.

    ``last_ok`` of an endpoint that never succeeded is the time it was first seen.
    """
    return history.select(
        "endpoint",
        F.coalesce("last_ok_ts", "first_ts").alias("last_ok"),
        F.col("n_ok").alias("ok_streak"),
        F.col("trail_fails").alias("fail_streak"),
    )


def states_of(
    history: DataFrame,
    as_of: Column,
    cooldown_base: timedelta | int = COOLDOWN_BASE_SECONDS,
    cap: int = COOLDOWN_CAP,
    dead_after: int = DEAD_AFTER_FAILURES,
) -> DataFrame:
    """``(endpoint, state, failures, ready_at)`` at ``as_of``; ``dead`` is final.

    An endpoint is dead after a failure of that kind or ``dead_after`` failures in a row, cools down
    after any other failure, and is good again after a success or once the cool-down is over.
    """
    seconds = int(cooldown_base.total_seconds()) if isinstance(cooldown_base, timedelta) else cooldown_base
    wait = cooldown_seconds(F.col("trail_fails"), seconds, cap)
    ready = F.timestamp_add("SECOND", wait, F.col("last_ts"))
    dead = F.col("any_dead") | (F.col("max_streak") >= dead_after)
    cooling = ~dead & (F.col("trail_fails") > 0) & (F.col("_ready") > F.col("_as_of"))
    return history.withColumn("_ready", ready).withColumn("_as_of", as_of).select(
        "endpoint",
        F.when(dead, "dead").when(cooling, "cooldown").otherwise("good").alias("state"),
        F.col("trail_fails").alias("failures"),
        F.when(cooling, F.col("_ready")).alias("ready_at"),
    )


def failure_streaks(log: DataFrame) -> DataFrame:
    """Longest and current run of failures per endpoint."""
    return streaks_of(endpoint_history(log))


def health_ledger(log: DataFrame, as_of: Column | None = None) -> DataFrame:
    return ledger_of(endpoint_history(log, as_of))


def pool_state(
    log: DataFrame,
    as_of: Column | None = None,
    cooldown_base: timedelta | int = COOLDOWN_BASE_SECONDS,
    cap: int = COOLDOWN_CAP,
    dead_after: int = DEAD_AFTER_FAILURES,
    endpoints: DataFrame | None = None,
) -> DataFrame:
    """States at ``as_of`` (the end of the log when not given); listed endpoints without any request are good."""
    history = endpoint_history(log, as_of)
    moment = history.agg(F.max("last_ts")).scalar() if as_of is None else as_of
    states = states_of(history, moment, cooldown_base, cap, dead_after)
    if endpoints is None:
        return states
    return (
        endpoints.select("endpoint").distinct().join(states, "endpoint", "full")
        .withColumn("state", F.coalesce("state", F.lit("good")))
        .withColumn("failures", F.coalesce("failures", F.lit(0)))
    )


def pool_stats(states: DataFrame) -> DataFrame:
    """One row ``(good, cooldown, dead)``."""
    return states.agg(*[F.count_if(F.col("state") == s).alias(s) for s in ("good", "cooldown", "dead")])


def failure_kinds(log: DataFrame) -> DataFrame:
    """Number of failed requests per status with the kind of failure it stands for."""
    counted = log.groupBy("status").agg(F.count("*").alias("n"))
    return counted.select("status", classify_failure(F.col("status")).alias("failure_type"), "n")


def split_ok_failed(log: DataFrame) -> DataFrame:
    return log.groupBy("endpoint").agg(
        F.count_if("ok").alias("n_ok"), F.count_if(~F.col("ok")).alias("n_failed")
    )


def first_n_passing(log: DataFrame, n: int, order: tuple[str, ...] = ("ts", "event_id")) -> DataFrame:
    """The checks made when checking stops after ``n`` passes, in log order.

    The n-th pass is found with a distributed top-n; the rest is a filter against that one value.
    """
    place = F.struct(*order)
    nth = (
        log.filter("ok").select(place.alias("_place")).orderBy("_place").limit(n)
        .agg(F.when(F.count("*") == n, F.max("_place")).alias("_cut")).scalar()
    )
    return log.filter(F.coalesce(place <= nth, F.lit(True)))
