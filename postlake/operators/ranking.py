"""First-seen and first-k selection that stays distributed when one key holds much of the data.

``row_number() <= k`` lets Spark cut every group to k rows before the shuffle, so a hot key costs k
rows per input partition. Spark does that only up to a threshold of k; above it the groups are
split by a salt first, into as many parts as a shuffle has partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """One row per key: the first in the given order."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


def top_per_group(
    df: DataFrame, groups: Sequence[str], order: Sequence[Column | str], k: int, position: str = "pos"
) -> DataFrame:
    """The first k rows of every group with their 1-based position."""
    threshold = int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000"))
    if k > threshold:
        salts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        salted = df.withColumn("_salt", F.pmod(F.xxhash64(*df.columns), F.lit(salts)))
        cut = Window.partitionBy(*groups, "_salt").orderBy(*order)
        df = salted.withColumn("_rank", F.row_number().over(cut)).filter(F.col("_rank") <= k).drop("_rank", "_salt")
    rank = F.row_number().over(Window.partitionBy(*groups).orderBy(*order))
    return df.withColumn(position, rank.cast("bigint")).filter(F.col(position) <= k)


def dedupe_first_seen(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """Distinct non-empty keys, each with its first-seen row.

    A table of just the key and one ordinal becomes a plain minimum, which Spark hashes and combines
    before the shuffle without sorting.
    """
    kept = df.filter(F.length(key) > 0)
    if list(order) == [c for c in df.columns if c != key]:
        if len(order) == 1:
            return kept.groupBy(key).agg(F.min(order[0]).alias(order[0]))
    return first_per_key(kept, [key], order)
