"""Enriching posts as they arrive, each of them once."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlake.functions import post_key, present
from postlake.operators.enrichment import enrich_posts
from postlake.operators.ranking import first_per_key
from postlake.streaming.running import drain


def stream_enrich(
    posts: DataFrame,
    details: DataFrame,
    folder: str,
    order: tuple[str, ...] = ("created_utc",),
    time: str | None = None,
    delay: timedelta | None = None,
) -> DataFrame:
    """Enrich the posts at hand that earlier batches did not write; ``details`` is a prepared table.

    A post is known by its key, its id or else its permalink; the first of a batch in ``order`` stays.
    Posts without a key cannot be told apart, so all of them pass. With ``time`` and ``delay`` copies of
    a post arrive at most ``delay`` apart, and a batch looks only at those earlier batches that reach
    into that span; without them it looks at the keys of all. A batch overwrites its own output and
    looks only at earlier ones, so a replay changes nothing.
    """
    out, spans = f"{folder}/enriched", f"{folder}/spans"
    bounded = time is not None and delay is not None

    def fold(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        keyed = batch.withColumn("_post_key", post_key(F.col("id"), F.col("permalink")))
        fresh = first_per_key(keyed.filter("_post_key <> ''"), ["_post_key"], list(order))
        if number:
            done = spark.read.parquet(out).filter(f"batch < {number}")
            if bounded:
                done = done.join(F.broadcast(_near(batch, number)), "batch", "left_semi")
            fresh = fresh.join(done.select("_post_key"), "_post_key", "left_anti")
        every = fresh.unionByName(keyed.filter("_post_key = ''"))
        enrich_posts(every, details).write.mode("overwrite").parquet(f"{out}/batch={number}")
        if bounded:
            span = batch.agg(F.max(time).alias("newest"))
            span.write.mode("overwrite").parquet(f"{spans}/batch={number}")

    def _near(batch: DataFrame, number: int) -> DataFrame:
        """The earlier batches, one row each, that hold posts less than ``delay`` before this one."""
        oldest = batch.agg(F.min(time)).scalar() - F.make_dt_interval(secs=F.lit(delay.total_seconds()))
        earlier = batch.sparkSession.read.parquet(spans).filter(f"batch < {number}")
        return earlier.filter(F.coalesce(F.col("newest") >= oldest, F.lit(True))).select("batch")

    drain(posts, fold, folder)
    return enriched_so_far(posts.sparkSession, folder).drop("batch")


def enriched_so_far(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/enriched").drop("_post_key")


def stream_enrich_late(
    posts: DataFrame, details: DataFrame, folder: str, order: tuple[str, ...] = ("created_utc",)
) -> DataFrame:
    """Enrich posts whose details come before, with or after them; both are streams.

    A post without details waits, and every batch tries the waiting ones again with the details that are
    new; so what comes out doesn't depend on the order in which posts and details arrive. ``details`` has one
    row per readable payload ``(permalink, body, n_comments, …)``; the first that come for a permalink stay.
    Posts are known by their key as in :func:`stream_enrich`, posts without a permalink wait for nothing.
    The result has all posts so far, those that still wait without details.

    Batch N reads what earlier batches wrote and overwrites its own output, so a replay changes nothing.
    It rewrites only posts that wait.
    """
    tried, known = f"{folder}/tried", f"{folder}/known"
    post = posts.select(F.struct("*").alias("post"))
    detail = details.select(F.struct("permalink", "body", "n_comments").alias("detail"))
    both = post.unionByName(detail, allowMissingColumns=True)

    def fold(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        earlier = lambda path: spark.read.parquet(path).filter(F.col("batch") < number)
        keyed = batch.filter("post IS NOT NULL").select("post.*")
        keyed = keyed.withColumn("_post_key", post_key(F.col("id"), F.col("permalink")))
        fresh = first_per_key(keyed.filter("_post_key <> ''"), ["_post_key"], list(order))
        come = batch.filter("detail IS NOT NULL").select("detail.*").filter(present(F.col("permalink")))
        new = first_per_key(come, ["permalink"], ["body", "n_comments"])
        if number:
            fresh = fresh.join(earlier(tried).select("_post_key"), "_post_key", "left_anti")
            new = new.join(earlier(known).select("permalink"), "permalink", "left_anti")
        new.write.mode("overwrite").option("compression", "zstd").parquet(f"{known}/batch={number}")
        new = spark.read.schema(new.schema).parquet(f"{known}/batch={number}")
        every = new.unionByName(earlier(known).select(*new.columns)) if number else new
        done = enrich_posts(fresh.unionByName(keyed.filter("_post_key = ''")), every)
        if number:
            waiting = spark.read.parquet(f"{tried}/batch={number - 1}").filter("waits")
            again = enrich_posts(waiting.select(*keyed.columns), new)
            done = done.unionByName(again)
        waits = present(F.col("permalink")) & ~F.col("has_details")
        done.withColumn("waits", waits).write.mode("overwrite").option("compression", "zstd").parquet(f"{tried}/batch={number}")

    drain(both, fold, folder)
    every = posts.sparkSession.read.parquet(tried)
    last = every.agg(F.max("batch")).scalar()
    return every.filter(~F.col("waits") | (F.col("batch") == last)).drop("batch", "waits", "_post_key")
