"""Normalising raw posts and removing duplicates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlake.functions import post_description, post_key, post_link
from postlake.operators.ranking import first_per_key

POST_FIELDS = (
    "id", "name", "title", "author", "subreddit", "permalink", "link", "description",
    "created_utc", "score", "num_comments",
)


def normalize_posts(raw: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """The eleven post fields from raw ones; ``keep`` names further columns to carry along."""
    permalink = F.coalesce(F.col("permalink"), F.lit(""))
    made = {
        "permalink": permalink,
        "link": post_link(permalink, F.col("url")),
        "description": post_description(F.col("selftext")),
    }
    return raw.select(*keep, *[made.get(f, F.col(f)).alias(f) for f in POST_FIELDS])


def with_key(posts: DataFrame) -> DataFrame:
    """Add ``key`` and drop the posts that have none."""
    permalink = F.col("permalink") if "permalink" in posts.columns else F.lit(None).cast("string")
    return posts.withColumn("key", post_key(F.col("id"), permalink)).filter(F.length("key") > 0)


def dedup_posts(posts: DataFrame, order: Sequence[Column | str]) -> DataFrame:
    """First post of every key in the given order, with its key."""
    return first_per_key(with_key(posts), ["key"], order)
