"""Endpoint health that is updated in place and exact in whatever order requests arrive.

The stored table has one segment per endpoint and time slice, in buckets of endpoints. A batch writes the segments
that it changes and nothing else, as a delta of their buckets; of several segments with one key that of the latest
batch counts. A bucket with too many deltas is written anew as a whole the next time it changes. A version lists
the deltas that count for each bucket; it is written last, as one small file, so a batch takes effect at once or not at all.

Requests that came after all others of their slice are appended to its segment by a formula over two rows. Only
where they did not is the segment opened again: it is computed from the kept outcomes of that endpoint and slice.
So there is no watermark, nothing waits, and no row is too late. The outcomes are stored once, by slice.

Batch N reads version N-1, so a batch that is run again writes the same tables. Deltas that a version replaces are
removed one batch later; the last two versions can be read.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from postlake.operators.health import SETTLED, SLICE, combine_segments, endpoint_segments, ledger_of, states_of
from postlake.session import remove
from postlake.streaming.running import drain

BUCKETS = 256
DELTAS = 8
# The slice of rows without a time; these come first, as nulls do in batch runs.
UNDATED = SETTLED - 1

_OUTCOME = "endpoint string, ts timestamp, event_id bigint, ok boolean, status int"
_SEGMENT = (
    "endpoint string, seq bigint, n bigint, n_ok bigint, lead_fails bigint, trail_fails bigint, max_streak bigint, "
    "any_dead boolean, first_ts timestamp, last_ts timestamp, last_ok_ts timestamp"
)
_VERSION = "bucket int, live array<bigint>, stale array<bigint>, buckets int, slice_micros bigint"
_FIELDS = [f.split()[0] for f in _OUTCOME.split(", ")]
_VALUES = [f.split()[0] for f in _SEGMENT.split(", ")]
# The row of a version that stands for the whole table.
_WHOLE = -1
# Rows of a cached partition; there are no fewer partitions than cores.
_ROWS = 100_000


def _micros(time_slice: timedelta) -> int:
    return time_slice // timedelta(microseconds=1)


def _segments(rows: DataFrame, time_slice: timedelta) -> DataFrame:
    return endpoint_segments(rows, time_slice).withColumn("seq", F.coalesce("seq", F.lit(UNDATED)))


def _cached(frame: DataFrame, rows: int) -> DataFrame:
    """``frame`` cached in as many partitions as its batch of ``rows`` needs.

    A cached shuffle keeps all its partitions, however small, and every later shuffle has a file for each pair.
    """
    return frame.coalesce(max(frame.sparkSession.sparkContext.defaultParallelism, -(-rows // _ROWS))).persist()


def _with_bucket(segments: DataFrame, buckets: int) -> DataFrame:
    return segments.withColumn("bucket", F.pmod(F.hash("endpoint"), F.lit(buckets)))


def _version(spark: SparkSession, folder: str, number: int) -> dict:
    """Rows of a version by bucket, as many as there are buckets at most."""
    rows = spark.read.schema(_VERSION).parquet(f"{folder}/versions/batch={number}").collect()
    return {r["bucket"]: r for r in rows}


def _stored(spark: SparkSession, folder: str, version: dict, buckets: list[int]) -> DataFrame:
    """All deltas that count for ``buckets``, with ``batch`` and ``bucket``."""
    paths = [
        f"{folder}/segments/batch={batch}/bucket={b}" for b in buckets if b in version for batch in version[b]["live"]
    ]
    schema = f"{_SEGMENT}, batch bigint, bucket int"
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", f"{folder}/segments").parquet(*paths)


def _latest(deltas: DataFrame) -> DataFrame:
    """One segment per endpoint and slice; partitioned by endpoint, as combining them is."""
    following = F.lead("seq").over(Window.partitionBy("endpoint").orderBy("seq", "batch"))
    return deltas.withColumn("_next", following).filter(~F.col("_next").eqNullSafe(F.col("seq"))).drop("_next", "batch")


def _same_key(left: str, right: str) -> Column:
    return F.col(f"{left}.endpoint").eqNullSafe(F.col(f"{right}.endpoint")) & (F.col(f"{left}.seq") == F.col(f"{right}.seq"))


def _appended() -> list[Column]:
    """The segment of ``old`` requests followed by ``new`` ones; that of the new ones where there are no old ones."""
    old, new = (lambda c: F.col(f"old.{c}")), (lambda c: F.col(f"new.{c}"))
    count = lambda c: F.coalesce(old(c), F.lit(0).cast("bigint"))
    values = {
        "n": count("n") + new("n"),
        "n_ok": count("n_ok") + new("n_ok"),
        "lead_fails": F.when(count("n_ok") > 0, old("lead_fails")).otherwise(count("n") + new("lead_fails")),
        "trail_fails": F.when(new("n_ok") > 0, new("trail_fails")).otherwise(count("trail_fails") + new("n")),
        "max_streak": F.greatest(old("max_streak"), new("max_streak"), count("trail_fails") + new("lead_fails")),
        "any_dead": F.greatest(old("any_dead"), new("any_dead")),
        "first_ts": F.least(old("first_ts"), new("first_ts")),
        "last_ts": F.greatest(old("last_ts"), new("last_ts")),
        "last_ok_ts": F.greatest(old("last_ok_ts"), new("last_ok_ts")),
    }
    return [new("endpoint"), new("seq"), new("bucket"), *[v.alias(c) for c, v in values.items()]]


def _keep(rows: DataFrame, folder: str, number: int, time_slice: timedelta) -> None:
    """Store the outcomes by slice, sorted by endpoint; a busy endpoint is split by time."""
    seq = F.coalesce(F.floor(F.unix_micros("ts") / _micros(time_slice)), F.lit(UNDATED))
    (
        rows.withColumns({"seq": seq, "batch": F.lit(number).cast("bigint")})
        .repartitionByRange("seq", "endpoint", "ts").sortWithinPartitions("seq", "endpoint")
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("seq", "batch")
        .parquet(f"{folder}/outcomes")
    )


def _reopened(rows: DataFrame, keys: DataFrame, folder: str, number: int, time_slice: timedelta) -> DataFrame | None:
    """Segments of ``keys`` from the outcomes of earlier batches and ``rows``; reads the slices of the keys only."""
    slices = [r["seq"] for r in keys.select("seq").distinct().collect()]
    if not slices:
        return None
    earlier = (
        rows.sparkSession.read.schema(f"{_OUTCOME}, seq bigint, batch bigint").option("basePath", f"{folder}/outcomes")
        .parquet(*[f"{folder}/outcomes/seq={s}" for s in slices]).filter(F.col("batch") < number)
    )
    seq = F.coalesce(F.floor(F.unix_micros("ts") / _micros(time_slice)), F.lit(UNDATED))
    both = earlier.select(*_FIELDS, "seq").unionByName(rows.withColumn("seq", seq))
    wanted = both.alias("row").join(keys.alias("key"), _same_key("row", "key"), "left_semi")
    return _segments(wanted.select(*_FIELDS), time_slice)


def update_ledger(
    batch: DataFrame, folder: str, number: int, time_slice: timedelta = SLICE, buckets: int = BUCKETS, deltas: int = DELTAS
) -> None:
    """Fold the requests of batch ``number`` (0, 1, ...) into the table in ``folder``.

    Every row counts, repeated ones as often as they come; those without an endpoint count as one endpoint,
    those without a time come before all others. ``time_slice`` and ``buckets`` are fixed by the first batch.
    """
    spark = batch.sparkSession
    before = _version(spark, folder, number - 1) if number else {}
    settings = (buckets, _micros(time_slice))
    if before and (before[_WHOLE]["buckets"], before[_WHOLE]["slice_micros"]) != settings:
        raise ValueError(f"{folder} has other buckets or time slices")
    rows = batch.select(*[F.col(f).cast(t) for f, t in (c.split() for c in _OUTCOME.split(", "))]).persist()
    n_rows = rows.count()
    fresh = _cached(_with_bucket(_segments(rows, time_slice), buckets), n_rows)
    placed = None
    try:
        _keep(rows, folder, number, time_slice)
        found = fresh.groupBy("bucket").agg(F.min("seq").alias("low"), F.max("seq").alias("high")).collect()
        touched = sorted(r["bucket"] for r in found)
        full = [b for b in touched if b in before and len(before[b]["live"]) >= deltas]
        if touched:
            changed = fresh
        if any(b in before for b in touched):
            low, high = min(r["low"] for r in found), max(r["high"] for r in found)
            old = _latest(_stored(spark, folder, before, touched).filter(F.col("seq").between(low, high)))
            placed = _cached(fresh.alias("new").join(old.alias("old"), _same_key("new", "old"), "left"), n_rows)
            in_order = F.col("old.n").isNull() | F.coalesce(F.col("new.first_ts") > F.col("old.last_ts"), F.lit(False))
            changed = placed.filter(in_order).select(*_appended())
            again = _reopened(rows, placed.filter(~in_order).select("new.endpoint", "new.seq"), folder, number, time_slice)
            if again is not None:
                changed = changed.unionByName(_with_bucket(again, buckets))
            if full:
                marked = changed.withColumn("batch", F.lit(number).cast("bigint"))
                changed = _latest(_stored(spark, folder, before, full).unionByName(marked))
        if touched:
            (
                changed.select(*_VALUES, "bucket").repartition("bucket").sortWithinPartitions("bucket", "endpoint", "seq")
                .write.mode("overwrite").partitionBy("bucket").parquet(f"{folder}/segments/batch={number}")
            )
    finally:
        for frame in (placed, fresh, rows):
            if frame is not None:
                frame.unpersist()
    live = {b: list(r["live"]) for b, r in before.items() if b != _WHOLE}
    for b in touched:
        live[b] = [number] if b in full else [*live.get(b, []), number]
    version = [(b, batches, list(before[b]["live"]) if b in full else [], *settings) for b, batches in live.items()]
    version.append((_WHOLE, [], [], *settings))
    spark.createDataFrame(version, _VERSION).coalesce(1).write.mode("overwrite").parquet(f"{folder}/versions/batch={number}")
    for b, row in before.items():
        for gone in row["stale"]:
            remove(spark, f"{folder}/segments/batch={gone}/bucket={b}")
    if number > 1:
        remove(spark, f"{folder}/versions/batch={number - 2}")


def _deltas(spark: SparkSession, folder: str, number: int | None = None) -> DataFrame:
    """All deltas that count as of batch ``number``, the last one when not given."""
    if number is None:
        versions = spark.read.schema(f"{_VERSION}, batch bigint").parquet(f"{folder}/versions")
        number = versions.agg(F.max("batch")).first()[0]
    version = _version(spark, folder, number)
    return _stored(spark, folder, version, list(version))


def kept_history(spark: SparkSession, folder: str, number: int | None = None) -> DataFrame:
    """One segment per endpoint as of batch ``number``, the last one when not given."""
    return combine_segments(_latest(_deltas(spark, folder, number)).drop("bucket"))


def stream_kept_ledger(log: DataFrame, folder: str, **layout) -> DataFrame:
    """The ledger after all requests at hand; ``layout`` as in :func:`update_ledger`."""
    drain(log, lambda batch, number: update_ledger(batch, folder, number, **layout), folder)
    return ledger_of(kept_history(log.sparkSession, folder))


def stream_kept_states(log: DataFrame, folder: str, as_of: Column | None = None, layout: dict | None = None, **rules) -> DataFrame:
    """States at ``as_of`` (the newest request when not given); ``rules`` as in ``pool_state``."""
    drain(log, lambda batch, number: update_ledger(batch, folder, number, **(layout or {})), folder)
    deltas = _deltas(log.sparkSession, folder)
    # A segment only grows, so deltas that later ones replace hold no later time.
    moment = deltas.agg(F.max("last_ts")).scalar() if as_of is None else as_of
    return states_of(combine_segments(_latest(deltas).drop("bucket")), moment, **rules)
