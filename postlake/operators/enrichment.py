"""Joining posts with their captured details, and the comment tables made from those."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlake.functions import comment_count, comment_nodes, comments_json, detail_url, present, readable_threads
from postlake.functions.expressions import LINK_HOST
from postlake.operators.ranking import first_per_key


def _readable(details: DataFrame) -> DataFrame:
    # Of a repeated JSON key the last one counts.
    details.sparkSession.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    return details.select("*", F.explode(readable_threads(F.col("payload"))).alias("_thread"))


def rejected_details(details: DataFrame) -> DataFrame:
    """``(…, reason)`` of the captures that no other operator here can read; the payload is left out.

    ``json``: no JSON text, or one beyond the parser's limits (1,000 nested brackets, 16 MiB of values);
    ``listings``: JSON without a post and a comment listing.
    """
    details.sparkSession.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    reason = F.when(F.try_parse_json("payload").isNull(), "json").otherwise("listings")
    unread = details.filter(F.coalesce(F.size(readable_threads(F.col("payload"))), F.lit(0)) < 1)
    return unread.withColumn("reason", reason).drop("payload")


def latest_details(details: DataFrame, with_comments: bool = False) -> DataFrame:
    """The parsed fields of the latest readable capture of every permalink; without ``fetched_at`` of any one.

    Captures are parsed before they are compared, so a later broken one hides nothing, and only parsed
    fields are shuffled.
    """
    order = [F.desc("fetched_at")] if "fetched_at" in details.columns else []
    named = details.filter(present(F.col("permalink"))).withColumn("_tie", F.xxhash64("payload"))
    return first_per_key(ingest_details(named, with_comments), ["permalink"], [*order, "_tie"]).drop("_tie")


def ingest_details(details: DataFrame, with_comments: bool = True) -> DataFrame:
    """``(…, title, body, n_comments[, comments])`` of the readable payloads, one row per payload.

    Input is ``(permalink, payload, …)``; further columns are kept. Unreadable payloads give no row, so
    their posts stay without details; :func:`rejected_details` lists them. Without comments they are
    only counted.
    """
    kept = [c for c in details.columns if c != "payload"]
    field = lambda name: F.try_variant_get(
        F.col("_thread"), f"$[0].data.children[0].data.{name}", "string"
    )
    base = [*kept, field("title").alias("title"), F.coalesce(field("selftext"), F.lit("")).alias("body")]
    threads = _readable(details)
    if not with_comments:
        return threads.select(*base, comment_count(F.col("_thread")).alias("n_comments"))
    named = threads.withColumn("comments", comment_nodes(F.col("_thread")))
    return named.select(*base, "comments", F.size("comments").cast("bigint").alias("n_comments"))


def flatten_comments(details: DataFrame, max_depth: int | None = None) -> DataFrame:
    """One row per comment: ``(…, path, depth, author, body, score)``. Row-local, so no shuffle."""
    kept = [c for c in details.columns if c != "payload"]
    nodes = comment_nodes(F.col("_thread"))
    flat = _readable(details).select(*kept, F.inline(nodes)).withColumn("depth", F.size("path"))
    if max_depth is not None:
        flat = flat.filter(F.col("depth") <= max_depth)
    return flat.select(*kept, "path", "depth", "author", "body", "score")


def nest_comments(details: DataFrame) -> DataFrame:
    """The comments of every payload as one nested JSON text, for document-style output."""
    kept = [c for c in details.columns if c != "payload"]
    nodes = comment_nodes(F.col("_thread"))
    return _readable(details).select(*kept, comments_json(nodes).alias("comments_json"))


def thread_stats(details: DataFrame) -> DataFrame:
    """``(…, n_comments, max_depth)`` of every payload with comments; row-local, so no shuffle."""
    kept = [c for c in details.columns if c != "payload"]
    nodes = _readable(details).select(*kept, comment_nodes(F.col("_thread")).alias("_nodes"))
    depth = F.array_max(F.transform("_nodes", lambda c: F.size(c["path"])))
    stats = [F.size("_nodes").cast("bigint").alias("n_comments"), depth.cast("bigint").alias("max_depth")]
    return nodes.select(*kept, *stats).filter("n_comments > 0")


def comment_stats(comments: DataFrame, key: str = "permalink") -> DataFrame:
    """As :func:`thread_stats`, for comments of which several payloads share a key."""
    return comments.groupBy(key).agg(
        F.count("*").alias("n_comments"), F.max("depth").cast("bigint").alias("max_depth")
    )


def detail_worklist(posts: DataFrame, done: DataFrame, host: str = LINK_HOST) -> DataFrame:
    """Posts still to be looked up, with the address to fetch; ``done`` lists known permalinks."""
    open_posts = posts.filter(present(F.col("permalink")))
    if "has_details" in posts.columns:
        open_posts = open_posts.filter(~F.coalesce("has_details", F.lit(False)))
    left = open_posts.join(done.select("permalink"), "permalink", "left_anti")
    return left.withColumn("detail_url", detail_url(F.col("permalink"), host))


def enrich_posts(posts: DataFrame, details: DataFrame, with_comments: bool = False) -> DataFrame:
    """Posts with ``body``, ``n_comments`` and ``has_details`` (and ``comments_json`` on request).

    ``details`` comes from :func:`latest_details`, one row per permalink, so no post is
    multiplied. Posts that have details already keep them, and posts that match nothing pass
    unchanged. Posts without a permalink can match nothing; their join
    key is made from their input partition, so that they do not pile up in one join partition. A
    permalink that many posts share stays exact because details are unique; adaptive skew joins split such a partition on the posts' side.
    """
    spread = F.concat(F.lit("\x00"), F.spark_partition_id())
    left = posts.withColumn("_key", F.when(present(F.col("permalink")), F.col("permalink")).otherwise(spread))
    right = details.filter(present(F.col("permalink"))).select(
        F.col("permalink").alias("_key"),
        F.col("body").alias("_body"),
        F.col("n_comments").alias("_n_comments"),
        F.lit(True).alias("_matched"),
        *([comments_json(F.col("comments")).alias("_comments_json")] if with_comments else []),
    )
    had = F.coalesce("has_details", F.lit(False)) if "has_details" in posts.columns else F.lit(False)
    added = ["body", "n_comments"] + (["comments_json"] if with_comments else [])

    def value(name: str):
        found = F.col(f"_{name}")
        return F.when(had, F.col(name)).otherwise(found) if name in posts.columns else found

    joined = left.join(right, "_key", "left")
    plain = [c for c in posts.columns if c not in {*added, "has_details"}]
    return joined.select(
        *plain,
        *[value(name).alias(name) for name in added],
        (had | F.coalesce("_matched", F.lit(False))).alias("has_details"),
    )


def _succeeded():
    return present(F.col("body")) | F.coalesce(F.col("n_comments") > 0, F.lit(False))


def enrichment_summary(enriched: DataFrame) -> DataFrame:
    """One row ``(total, success, failed)``. The failed ids are a table: :func:`failed_posts`.

    Rejected captures are counted apart: ``rejected_details(...).groupBy("reason").count()``.
    """
    return enriched.agg(
        F.count("*").alias("total"),
        F.count_if(_succeeded()).alias("success"),
        F.count_if(~_succeeded()).alias("failed"),
    )


def failed_posts(enriched: DataFrame) -> DataFrame:
    """The posts that enrichment left without body and comments; a missing id reads ``unknown``."""
    return enriched.filter(~_succeeded()).withColumn("id", F.coalesce("id", F.lit("unknown")))
