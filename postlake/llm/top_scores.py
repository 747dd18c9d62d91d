"""Exact top-k inner products by a three-phase uniform threshold over slices of the dimensions."""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from postlake.llm.common import group_bounds, list_matrix, stored, whole_groups

SLICES = 2
CELL_ROWS = 16384
QUERY_ROWS = 1024
_AT_ONCE = 2048
_EXACT_IN_DOUBLES = float(1 << 53)
# Sums of products whose sizes add up to less than this fit a long, also when the estimate is rounded.
_FITS_LONG = float(1 << 62)
_LOWEST, _HIGHEST = -(1 << 63), (1 << 63) - 1


def scaled(embedding: Column, factor: int = 1024) -> Column:
    """Components as ``floor(factor * x)``, whole numbers of any size held in doubles; null for unusable vectors.

    Those are vectors with components that are null or, times ``factor``, not finite.
    """

    def whole(x: Column) -> Column:
        # From 2^53 on every double is a whole number, and it need not fit the long that floor() gives.
        value = x.cast("double") * factor
        return F.when(F.abs(value) < _EXACT_IN_DOUBLES, F.floor(value).cast("double")).otherwise(value)

    finite = lambda x: F.coalesce(~F.isnan(x) & (F.abs(x.cast("double") * factor) < float("inf")), F.lit(False))
    return F.when(F.forall(embedding, finite), F.transform(embedding, whole))


def _wide_product(a: np.ndarray, b: np.ndarray, least: int = _LOWEST) -> int:
    """Inner product of whole numbers of any size, brought into the range from ``least`` to the highest long."""
    return min(max(sum(int(x) * int(y) for x, y in zip(a, b, strict=True)), least), _HIGHEST)


def inner_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``a @ b.T`` of whole numbers: by doubles where they are exact, else by 64-bit integers where they are.

    Pairs of large vectors whose product may exceed both are computed without bound and brought into the range of
    longs but the lowest.
    """
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), np.int64)
    a, b = a.astype(np.float64), b.astype(np.float64)
    most_a, most_b = np.abs(a).max(axis=1), np.abs(b).max(axis=1)
    if most_a.max() * most_b.max() * a.shape[1] < _EXACT_IN_DOUBLES:
        return (a @ b.T).astype(np.int64)
    # Components that no long holds are left to the pairs below: theirs are risky but with all-zero vectors.
    as_long = lambda x: np.where(np.abs(x) < _FITS_LONG, x, 0).astype(np.int64)
    scores = as_long(a) @ as_long(b).T
    with np.errstate(over="ignore"):
        risky = most_a[:, None] * most_b[None] * a.shape[1] >= _FITS_LONG
    for i, j in zip(*np.nonzero(risky), strict=True):
        scores[i, j] = _wide_product(a[i], b[j], -_HIGHEST)
    return scores


@F.pandas_udf(LongType())
def _wide_score(a: pd.Series, b: pd.Series) -> pd.Series:
    pairs = zip(a, b, strict=True)
    return pd.Series([None if x is None or y is None else _wide_product(x, y) for x, y in pairs], dtype="Int64")


def _score(a: str, b: str, most_a: str, most_b: str) -> Column:
    """Exact inner product of vectors with their largest components, brought into the range of longs."""
    fits = F.col(most_a) * F.col(most_b) * F.size(a) < _EXACT_IN_DOUBLES
    narrow = F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda total, x: total + x)
    # Only pairs that doubles may not hold are sent to Python.
    return F.when(fits, narrow.cast("bigint")).otherwise(_wide_score(F.when(~fits, F.col(a)), F.when(~fits, F.col(b))))


def _local(batches: Iterator[pa.RecordBatch], k: int | None) -> Iterator[pa.RecordBatch]:
    """Per cell, slice and block of queries: each query's ``k`` best entries, or with None those at its cut-off."""
    keys = ["block", "cell", "slice", "dims"]
    for table in whole_groups(batches, keys):
        for first, last in zip(*group_bounds(table, keys), strict=True):
            group = table.slice(first, last - first)
            asks = group.column("cut").is_valid().to_numpy()
            queries, rows = np.flatnonzero(asks), np.flatnonzero(~asks)
            if not len(queries) or not len(rows):
                continue
            width = len(group.column("values")[0])
            values = list_matrix(group.column("values"), width, np.float64)
            uid, vec = group.column("uid").to_numpy(), group.column("vec")
            own = vec.fill_null(-1).to_numpy()
            cut = group.column("cut").to_numpy()[queries]
            slice_ = group.column("slice")[0].as_py()
            for begin in range(0, len(rows), _AT_ONCE):
                some = rows[begin : begin + _AT_ONCE]
                scores = inner_products(values[queries], values[some])
                other = uid[queries][:, None] != uid[some][None]
                unnamed = vec.take(pa.array(some)).is_null().to_numpy()
                other &= (own[queries][:, None] != own[some][None]) | unnamed[None]
                if k is None:
                    q, c = np.nonzero(other & (scores >= cut[:, None]))
                else:
                    held = np.where(other, scores, np.iinfo(np.int64).min)
                    best = np.argpartition(~held, k - 1, axis=1)[:, :k] if k < len(some) else np.arange(len(some))[None]
                    q = np.repeat(np.arange(len(queries)), best.shape[1])
                    c = np.broadcast_to(best, (len(queries), best.shape[1])).ravel()
                    q, c = q[other[q, c]], c[other[q, c]]
                columns = [uid[queries][q], uid[some][c], np.full(len(q), slice_), scores[q, c]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, pa.int64()) for x in columns], ["query", "uid", "slice", "score"]
                )


def top_scores(
    vectors: DataFrame, queries: Column, k: int = 10, slices: int = SLICES, factor: int = 1024
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` best of all other rows for every row that ``queries`` holds for.

    Scores are inner products of the scaled whole-number vectors; ties go to the smaller ``vec_id``.
    Every vector is cut into ``slices`` of its dimensions, and a list holds the part scores of a query
    in one slice. First phase: each cell of rows gives the best ``k`` entries of its part of a list, and
    the entries' exact scores are looked up; the k-th best of them is a safe cut-off. Second phase: the
    cut-off divided by the number of slices goes to all lists (uniform threshold), and they give all
    entries that reach it; a row that reaches the cut-off must reach that threshold in some slice.
    Third phase: rows that did not come from every slice get their exact score, and the best ``k`` stay.

    Queries and rows meet in blocks and cells of bounded size, so no task holds all of either. Vectors
    that are null or hold null or non-finite components (see :func:`scaled`) take no part, and
    vectors of other lengths do not meet. Components may be of any size; a score beyond the range of longs counts
    as the nearest long. Rows with the query's own id are left out; null ids can be found, after all others in
    ties, but do not ask; repeated rows are found as often as they are there; other columns are ignored.
    """
    usable = vectors.select("vec_id", scaled(F.col("embedding"), factor).alias("whole"), queries.alias("asks"))
    usable = usable.filter(F.col("whole").isNotNull() & (F.size("whole") > 0))
    asks = F.coalesce("asks", F.lit(False)) & F.col("vec_id").isNotNull()
    rows = stored(
        usable.select(
            "vec_id", "whole", F.array_max(F.transform("whole", F.abs)).alias("most"), asks.alias("asks"),
            F.monotonically_increasing_id().alias("uid"),
        ),
        "vectors",
    )
    count, asking = rows.agg(F.count("*"), F.count_if("asks")).first()
    cells, blocks = max(1, ceil(count / CELL_ROWS)), max(1, ceil(asking / QUERY_ROWS))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    size = F.size("whole")
    edge = lambda s: F.floor(size * s / slices).cast("int")
    cut_up = F.explode(
        F.array(*[
            F.struct(F.lit(s).alias("slice"), F.slice("whole", edge(s) + 1, edge(s + 1) - edge(s)).alias("values"))
            for s in range(slices)
        ])
    )
    sliced = rows.select("uid", F.col("vec_id").alias("vec"), "asks", size.alias("dims"), cut_up.alias("_s"))
    sliced = sliced.select("uid", "vec", "asks", "dims", "_s.*").filter(F.size("values") > 0)
    mine = lambda n, salt: F.pmod(F.xxhash64("uid", F.lit(salt)), F.lit(n)).cast("int")
    names = ["block", "cell", "slice", "dims", "uid", "vec", "values", "cut"]
    searched = sliced.withColumns({"cell": mine(cells, 1), "cut": F.lit(None).cast("bigint")})
    searched = searched.withColumn("block", every(blocks)).select(*names)

    def lists(cuts: DataFrame, best: int | None) -> DataFrame:
        asked = sliced.filter("asks").join(cuts.select("uid", "cut"), "uid")
        asked = asked.withColumn("block", mine(blocks, 2)).withColumn("cell", every(cells)).select(*names)
        dealt = asked.unionByName(searched).repartition(*names[:4]).sortWithinPartitions(*names[:4])
        schema = "query bigint, uid bigint, slice bigint, score bigint"
        return dealt.mapInArrow(lambda batches: _local(batches, best), schema)

    vector = rows.select("uid", "vec_id", "whole", "most")
    ask = rows.filter("asks").selectExpr("uid AS query", "vec_id AS query_id", "whole AS asked", "most AS most_asked")
    score = _score("asked", "whole", "most_asked", "most")
    ranked = Window.partitionBy("query").orderBy(F.desc("total"), F.asc_nulls_last("vec_id"), "uid")

    parts = F.least(F.lit(slices), F.size("whole"))
    everyone = rows.filter("asks").select("uid", parts.alias("_parts"), F.lit(0).cast("bigint").alias("cut"))
    gathered = lists(everyone, k).select("query", "uid").distinct()
    both = gathered.join(vector, "uid").join(ask, "query")
    looked_up = both.select("query", "uid", "vec_id", score.alias("total"))
    safe = looked_up.withColumn("_rank", F.row_number().over(ranked)).filter(F.col("_rank") == k)
    lowest = F.lit(_LOWEST).cast("bigint")
    # Division cuts towards zero: whole part scores below the exact share stay below this one. Scores below all
    # longs tie with the lowest, so all rows may then be among the best.
    share = F.when(F.col("total") > lowest, F.expr("total div _parts"))
    cuts = everyone.drop("cut").join(safe.select(F.col("query").alias("uid"), "total"), "uid", "left")
    cuts = stored(cuts.select("uid", F.coalesce(share, lowest).alias("cut")), "cut-offs")
    # Parts at the end of the range may have been brought into it, and their sum may leave it.
    sure = F.max(F.abs("score")) < _HIGHEST
    seen = F.when(sure, F.try_sum("score")).alias("_seen")
    entries = lists(cuts, None).groupBy("query", "uid").agg(seen, F.count("*").alias("_slices"))
    entries = stored(entries, "entries")
    found = entries.join(vector, "uid").join(ask, "query").select(
        "query", "query_id", "uid", "vec_id",
        F.when((F.col("_slices") == parts) & F.col("_seen").isNotNull(), F.col("_seen"))
        .otherwise(score).alias("total"),
    )
    best = found.withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= k)
    return best.select("query_id", "rank", "vec_id", F.col("total").alias("score"))
