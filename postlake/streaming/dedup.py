"""Dropping posts that were seen before, within a watermark."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlake.operators.posts import with_key


def stream_dedup(
    stream: DataFrame, keys: Sequence[str], time: str, delay: str, fan_out: int = 16
) -> DataFrame:
    """First row of every key; copies arrive at most ``delay`` apart.

    With ``fan_out`` the copies of a hot key are first dropped on ``fan_out`` tasks by input
    partition, so the final stage sees at most ``fan_out`` of them per micro-batch. It keeps each key
    in state twice; 0 turns it off.
    """
    marked = stream.withWatermark(time, delay)
    if fan_out:
        salted = marked.withColumn("_salt", F.spark_partition_id() % fan_out)
        marked = salted.dropDuplicatesWithinWatermark([*keys, "_salt"]).drop("_salt")
    return marked.dropDuplicatesWithinWatermark(list(keys))


def stream_dedup_posts(posts: DataFrame, time: str, delay: str, fan_out: int = 16) -> DataFrame:
    return stream_dedup(with_key(posts), ["key"], time, delay, fan_out)
