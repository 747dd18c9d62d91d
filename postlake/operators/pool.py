"""Endpoint lists and their ledger: merging sources, refreshing a pool, upserts."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postlake.functions import normalize_endpoint
from postlake.operators.ranking import dedupe_first_seen, first_per_key

LEDGER_FIELDS = ("endpoint", "last_ok", "ok_streak", "fail_streak")


def parse_endpoints(lines: DataFrame, line: str = "line", order: Sequence[str] = ("pos",)) -> DataFrame:
    """Normalised, distinct endpoints of a list with the place they were first seen at."""
    named = lines.select(normalize_endpoint(F.col(line)).alias("endpoint"), *order)
    return dedupe_first_seen(named, "endpoint", order)


def merge_sources(sources: Sequence[DataFrame], line: str = "line") -> DataFrame:
    """One list ``(endpoint, src_idx, pos)`` from several ``(line, pos)``; earlier sources go first."""
    placed = [s.select(line, F.lit(i).cast("bigint").alias("src_idx"), "pos") for i, s in enumerate(sources)]
    return parse_endpoints(reduce(DataFrame.unionByName, placed), line, ("src_idx", "pos"))


def refresh_pool(good: DataFrame, existing: DataFrame, target: int) -> DataFrame:
    """``(endpoint, rank, tested)`` of the new pool: freshly tested ones, then existing ones, ``target`` in all.

    Both inputs are ``(endpoint, pos)``. When no endpoint passed the test the pool stays as it is,
    whole and in its own order. Ranks count from 1 either way.
    """
    tested = good.select("endpoint", F.lit(0).alias("_source"), "pos")
    kept = existing.select("endpoint", F.lit(1).alias("_source"), "pos")
    order = ["_source", "pos"]
    merged = dedupe_first_seen(tested.unionByName(kept), "endpoint", order)
    any_good = F.coalesce(merged.agg(F.min("_source")).scalar() == 0, F.lit(False))
    # At most ``target`` rows reach this window.
    leading = merged.filter(any_good).orderBy(*order).limit(target)
    fresh = leading.select(
        "endpoint",
        F.row_number().over(Window.orderBy(*order)).cast("bigint").alias("rank"),
        (F.col("_source") == 0).alias("tested"),
    )
    unchanged = _numbered(existing.filter(~any_good)).withColumn("tested", F.lit(False))
    return fresh.unionByName(unchanged)


def _numbered(listed: DataFrame) -> DataFrame:
    """``(endpoint, rank)`` by ``pos``, counted inside stretches of positions and over the stretches."""
    placed = listed.select("endpoint", "pos", F.floor(F.col("pos") / 1024).alias("_stretch"))
    sizes = placed.groupBy("_stretch").agg(F.count("*").alias("_n"))
    over = Window.orderBy("_stretch").rowsBetween(Window.unboundedPreceding, -1)
    earlier = sizes.select("_stretch", F.coalesce(F.sum("_n").over(over), F.lit(0)).alias("_earlier"))
    inside = F.row_number().over(Window.partitionBy("_stretch").orderBy("pos", "endpoint"))
    return placed.withColumn("_at", inside).join(earlier, "_stretch").select(
        "endpoint", (F.col("_earlier") + F.col("_at")).cast("bigint").alias("rank")
    )


def seed_ledger(endpoints: DataFrame, now: Column) -> DataFrame:
    """Ledger rows of endpoints that were never used."""
    return endpoints.select(
        "endpoint",
        now.alias("last_ok"),
        F.lit(0).cast("bigint").alias("ok_streak"),
        F.lit(0).cast("bigint").alias("fail_streak"),
    )


def upsert_ledger(ledger: DataFrame, endpoints: DataFrame, now: Column) -> DataFrame:
    """Ledger plus a fresh row for every listed endpoint it lacks."""
    unseen = endpoints.select("endpoint").distinct().join(ledger.select("endpoint"), "endpoint", "left_anti")
    return ledger.select(*LEDGER_FIELDS).unionByName(seed_ledger(unseen, now))


def refresh_ledger(ledger: DataFrame, pool: DataFrame, now: Column, bump_untested: bool = False) -> DataFrame:
    """Ledger of exactly the pool's endpoints after a refresh.

    A tested endpoint (``pool.tested``) counts one more success now. ``bump_untested`` credits every
    pool row that way, tested or not.
    """
    credited = F.lit(True) if bump_untested else F.coalesce("tested", F.lit(False))
    old = ledger.select(*LEDGER_FIELDS)
    joined = pool.select("endpoint", *(["tested"] if "tested" in pool.columns else [])).join(old, "endpoint", "left")
    oks = F.coalesce("ok_streak", F.lit(0))
    return joined.select(
        "endpoint",
        F.when(credited, now).otherwise(F.coalesce("last_ok", now)).alias("last_ok"),
        F.when(credited, oks + 1).otherwise(oks).alias("ok_streak"),
        F.when(credited, F.lit(0)).otherwise(F.coalesce("fail_streak", F.lit(0))).alias("fail_streak"),
    )


def missing_rows(target: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Rows of ``new`` whose key the target lacks, one per key."""
    order = [c for c in new.columns if c != key]
    distinct = first_per_key(new, [key], order) if order else new.distinct()
    return distinct.join(target.select(key), key, "left_anti")


def append_if_absent(target: DataFrame, new: DataFrame, key: str) -> DataFrame:
    return target.unionByName(missing_rows(target, new, key).select(*target.columns))
