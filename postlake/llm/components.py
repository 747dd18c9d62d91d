"""Connected components of an edge table by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlake.llm.common import stored


def _toward(edges: DataFrame, lowest: DataFrame, on: str) -> DataFrame:
    """Edges with the lowest neighbour of their ``on`` end; both inputs are stored, so a hot end can be split."""
    return edges.join(stored(lowest, "lowest"), on)


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, component)`` for every node of an edge; the component is its smallest node.

    Each round links every node's larger neighbours to its smallest one, then its smaller neighbours
    too, until only stars around the smallest nodes are left. The number of rounds grows with the
    logarithm of the largest component. Edges with a null end and loops are ignored, repeated edges
    count once, and no edges give no rows. Every round is a stored table of two longs a row, so a lost
    executor costs one step; the driver sees one count and one checksum a round.
    """
    high, low = F.greatest(a, b).alias("high"), F.least(a, b).alias("low")
    current = stored(edges.filter(F.col(a) != F.col(b)).select(high, low).distinct(), "edges")
    seen = None
    while True:
        mark = current.agg(F.count("*"), F.sum(F.xxhash64("high", "low").cast("decimal(38,0)"))).first()
        if mark[0] == 0 or tuple(mark) == seen:
            return current.select(F.col("high").alias("node"), F.col("low").alias("component")).unionByName(
                current.select(F.col("low").alias("node"), F.col("low").alias("component")).distinct()
            )
        seen = tuple(mark)
        both = current.select(F.col("low").alias("node"), F.col("high").alias("other")).unionByName(
            current.select(F.col("high").alias("node"), F.col("low").alias("other"))
        )
        lowest = both.groupBy(F.col("node").alias("low")).agg(F.min("other").alias("_least"))
        large = _toward(current, lowest, "low").select("high", F.least("low", "_least").alias("low")).distinct()
        large = stored(large, "large-star")
        lowest = large.groupBy("high").agg(F.min("low").alias("_least"))
        joined = _toward(large, lowest, "high")
        small = joined.select("high", F.col("_least").alias("low")).unionByName(
            joined.filter("low <> _least").select(F.col("low").alias("high"), F.col("_least").alias("low"))
        )
        current = stored(small.distinct(), "small-star")
