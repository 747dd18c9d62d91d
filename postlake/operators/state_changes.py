"""When the state of each endpoint changes: by a request, or by the clock once a cool-down is over.

The table of changes answers ``pool_state`` for every moment at once. The log is partitioned by endpoint and
time slice, as for segments; what a slice starts from is the sum of the segments before it, one row per
slice, so a busy endpoint is worked on by many tasks.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postlake.functions import classify_failure, cooldown_seconds
from postlake.functions.expressions import COOLDOWN_BASE_SECONDS, COOLDOWN_CAP, DEAD_AFTER_FAILURES
from postlake.operators.health import SETTLED, SLICE, endpoint_segments


def _starts(segments: DataFrame, dead_after: int) -> DataFrame:
    """What each segment starts from: the running streak, whether dead, whether seen, and when the next begins."""
    order = Window.partitionBy("endpoint").orderBy("seq")
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    rows_before = F.coalesce(F.sum("n").over(earlier), F.lit(0))
    placed = segments.withColumn("_before", rows_before)
    last_ok = F.when(F.col("n_ok") > 0, F.col("_before") + F.col("n") - F.col("trail_fails"))
    placed = placed.withColumn("_last_ok", last_ok)
    placed = placed.withColumn("carried", F.col("_before") - F.coalesce(F.max("_last_ok").over(earlier), F.lit(0)))
    longest = F.greatest("max_streak", F.col("carried") + F.col("lead_fails"))
    dies = F.coalesce("any_dead", F.lit(False)) | (longest >= dead_after)
    return placed.withColumn("_dies", dies).select(
        "endpoint", "seq", "carried", F.coalesce(F.max("_dies").over(earlier), F.lit(False)).alias("was_dead"),
        (F.col("_before") > 0).alias("seen"), F.lead("first_ts").over(order).alias("next_first"),
        F.col("_dies").alias("dies"), "trail_fails", "last_ts",
    )


def state_changes(
    log: DataFrame,
    cooldown_base: timedelta | int = COOLDOWN_BASE_SECONDS,
    cap: int = COOLDOWN_CAP,
    dead_after: int = DEAD_AFTER_FAILURES,
    upto: Column | None = None,
    history: DataFrame | None = None,
    after: Column | None = None,
    time_slice: timedelta = SLICE,
) -> DataFrame:
    """``(endpoint, at, state, failures, ready_at)``, rules as in ``pool_state``.

    An instant has a row if one of its requests is the endpoint's first, a failure, or the success that ends a
    streak; it gives the state after all requests of that instant. The end of a cool-down has a row if no request
    came before it or with it, up to ``upto`` when given. Until its first row an endpoint is not known.

    ``history`` holds a segment for each endpoint of earlier requests, all of them before ``log``, whose changes
    up to ``after`` are known; their cool-downs go on. Rows without an endpoint or a time take no part; a request
    of unknown outcome adds to a streak.
    """
    seconds = int(cooldown_base.total_seconds()) if isinstance(cooldown_base, timedelta) else cooldown_base
    width = time_slice // timedelta(microseconds=1)
    timed = log.filter(F.col("ts").isNotNull() & F.col("endpoint").isNotNull())
    segments = endpoint_segments(timed, time_slice)
    if history is not None:
        earlier = history.filter(F.col("endpoint").isNotNull()).select(*segments.columns)
        segments = earlier.withColumn("seq", F.lit(SETTLED).cast("bigint")).unionByName(segments)
    starts = _starts(segments, dead_after)
    ready = lambda streak, ts: F.timestamp_add("SECOND", cooldown_seconds(F.col(streak), seconds, cap), F.col(ts))

    rows = timed.select(
        "endpoint", "ts", "event_id", "ok", F.floor(F.unix_micros("ts") / width).alias("seq"),
        (~F.col("ok") & (classify_failure(F.col("status")) == "dead")).alias("_final"),
    )
    rows = rows.join(starts.select("endpoint", "seq", "carried", "was_dead", "seen", "next_first"), ["endpoint", "seq"])
    stretch = Window.partitionBy("endpoint", "seq").orderBy("ts", "event_id")
    numbered = rows.withColumn("_n", F.row_number().over(stretch).cast("bigint"))
    last_ok = F.max(F.when(F.col("ok"), F.col("_n"))).over(stretch)
    streak = F.when(F.col("ok"), F.lit(0).cast("bigint")).otherwise(
        F.coalesce(F.col("_n") - last_ok, F.col("_n") + F.col("carried"))
    )
    counted = numbered.withColumn("streak", streak).withColumns({
        "dead": F.col("was_dead") | F.coalesce(F.max("_final").over(stretch), F.lit(False))
        | (F.max("streak").over(stretch) >= dead_after),
        "_previous": F.coalesce(F.lag("streak").over(stretch), "carried"),
        "_next": F.coalesce(F.lead("ts").over(stretch), "next_first"),
    })
    changed = (F.col("streak") > 0) | (F.col("_previous") > 0) | (~F.col("seen") & (F.col("_n") == 1))
    instant = Window.partitionBy("endpoint", "seq", "ts")
    settled = counted.withColumn("_changed", F.max(changed).over(instant))
    settled = settled.filter(F.col("_next").isNull() | (F.col("_next") > F.col("ts")))
    settled = settled.withColumn("ready", ready("streak", "ts"))
    cooling = ~F.col("dead") & (F.col("streak") > 0) & (F.col("ready") > F.col("ts"))
    alone = F.col("_next").isNull() | (F.col("_next") > F.col("ready"))
    due = F.lit(True) if upto is None else F.col("ready") <= upto
    none = F.lit(None).cast("timestamp")
    change = lambda at, state, failures, ready_at: F.struct(
        at.alias("at"), state.alias("state"), failures.cast("bigint").alias("failures"), ready_at.alias("ready_at")
    )
    state = F.when(F.col("dead"), "dead").when(cooling, "cooldown").otherwise("good")
    by_request = F.when(
        F.col("_changed"), change(F.col("ts"), state, F.col("streak"), F.when(cooling, F.col("ready")))
    )
    by_clock = F.when(cooling & alone & due, change(F.col("ready"), F.lit("good"), F.col("streak"), none))
    out = settled.select("endpoint", F.explode(F.array_compact(F.array(by_request, by_clock))).alias("c"))
    if history is not None:
        waiting = starts.filter(F.col("seq") == SETTLED).withColumn("ready", ready("trail_fails", "last_ts"))
        alone = F.col("next_first").isNull() | (F.col("next_first") > F.col("ready"))
        waiting = waiting.filter(~F.col("dies") & (F.col("trail_fails") > 0) & alone & due)
        waiting = waiting if after is None else waiting.filter(F.col("ready") > after)
        over = change(F.col("ready"), F.lit("good"), F.col("trail_fails"), none)
        out = out.unionByName(waiting.select("endpoint", over.alias("c")))
    return out.select("endpoint", "c.*")


def states_at(changes: DataFrame, as_of: Column) -> DataFrame:
    """``pool_state`` at ``as_of`` from the changes up to then; one row per endpoint known by then."""
    last = F.max_by(F.struct("state", "failures", "ready_at"), "at").alias("c")
    return changes.filter(F.col("at") <= as_of).groupBy("endpoint").agg(last).select("endpoint", "c.*")
