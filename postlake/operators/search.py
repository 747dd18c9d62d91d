"""Keyword search over posts, paging of its hits, and the statistics of a multi-query run."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from postlake.functions import clamp_page_size, present, words
from postlake.operators.ranking import first_per_key, top_per_group

_BROADCAST_BYTES = 8 << 20
# A query of n characters has at most n / 2 words of some 24 bytes each, besides its characters.
_BYTES_PER_CHARACTER = 13


def _asked(spark: SparkSession, queries: Sequence[str] | DataFrame) -> tuple[DataFrame, bool]:
    """The query table, and whether it is known to be small enough for a broadcast."""
    if isinstance(queries, DataFrame):
        return queries, False
    distinct = list(dict.fromkeys(queries))
    table = pa.table(
        {
            "q_idx": pa.array(range(1, len(distinct) + 1), pa.int32()),
            "query": pa.array(distinct, pa.string()),
        }
    )
    return spark.createDataFrame(table), table.nbytes * _BYTES_PER_CHARACTER <= _BROADCAST_BYTES


def query_list(spark: SparkSession, queries: Sequence[str]) -> DataFrame:
    """``(q_idx, query)`` in list order, counted from 1; a repeated text keeps its first place."""
    return _asked(spark, queries)[0]


def keyword_search(
    posts: DataFrame,
    queries: Sequence[str] | DataFrame,
    limit: int,
    text: str = "text",
    ordinal: str = "doc_id",
    extra_filters: Column | None = None,
) -> DataFrame:
    """Best ``limit`` distinct posts per query: ``(q_idx, query, id, <ordinal>, tf, pos)``.

    The score is the number of occurrences of the query's words, ties go to the lower ordinal, which
    must tell posts apart. Words are matched against the query words before anything is shuffled, so
    the shuffle carries hits only and scanning a text costs the same for any number of queries. The
    query words are broadcast when their size allows it; otherwise, and for a query table, Spark
    picks the join from the sizes it sees and splits skewed words. A listed query without any word is
    an error; one in a table finds nothing.
    """
    asked, small = _asked(posts.sparkSession, queries)
    if not isinstance(queries, DataFrame):
        empty = [q for q in queries if not any(c.isalnum() for c in q)]
        if empty:
            raise ValueError(f"queries without a word: {empty}")
    sized = F.broadcast if small else lambda frame: frame
    terms = asked.select("q_idx", F.explode(F.array_distinct(words(F.col("query")))).alias("word")).filter("word <> ''")
    if extra_filters is not None:
        posts = posts.filter(extra_filters)
    found = (
        posts.filter(present(F.col("id")))
        .select("id", ordinal, F.explode(words(F.col(text))).alias("word"))
        .join(sized(terms), "word")
        .groupBy("q_idx", "id", ordinal)
        .agg(F.count("*").alias("tf"))
    )
    best = [F.desc("tf"), F.asc(ordinal)]
    distinct = first_per_key(found, ["q_idx", "id"], best)
    hits = top_per_group(distinct, ["q_idx"], best, limit)
    return hits.join(sized(asked), "q_idx").select("q_idx", "query", "id", ordinal, "tf", "pos")


def search_page(
    hits: DataFrame, batch_size: int, after: Mapping[str, str | None] | DataFrame | None = None
) -> DataFrame:
    """Cut every query's hits into pages; a page's token is its last id, or null on the last page.

    ``after`` has the token to go on from for each query, as a map or a table ``(query, after)``: its
    pages start behind that id. A query without a token, or with one that is none of its hits, starts
    at its first page. A query has at most ``limit`` hits, which bounds the windows.
    """
    size = clamp_page_size(batch_size)
    per_query = Window.partitionBy("q_idx", "query")
    if after is not None:
        if not isinstance(after, DataFrame):
            after = hits.sparkSession.createDataFrame(list(after.items()), "query string, after string")
        tokens = after.select("query", F.col("after").alias("_after"))
        seen = F.max(F.when(F.col("id") == F.col("_after"), F.col("pos"))).over(per_query)
        hits = hits.join(tokens, "query", "left").withColumn("_seen", F.coalesce(seen, F.lit(0)))
        hits = hits.filter("pos > _seen").withColumn("_rel", F.expr("pos - _seen")).drop("_after")
    else:
        hits = hits.withColumn("_rel", F.col("pos"))
    page = F.floor((F.col("_rel") - 1) / size).cast("bigint")
    on_page = Window.partitionBy("q_idx", "query", "page_no")
    return (
        hits.withColumn("page_no", page)
        .withColumn("_end", F.max("_rel").over(per_query))
        .withColumn("_page_end", F.max("_rel").over(on_page))
        .withColumn("_last_id", F.max_by("id", "_rel").over(on_page))
        .withColumn("next_token", F.when(F.col("_page_end") < F.col("_end"), F.col("_last_id")))
        .drop("_rel", "_seen", "_end", "_page_end", "_last_id")
    )


def search_multi(hits: DataFrame, order: Sequence[str] = ("q_idx", "pos")) -> DataFrame:
    """Distinct posts over all queries; each belongs to the earliest query that found it."""
    return first_per_key(hits, ["id"], order)


def _counts(hits: DataFrame, queries: Sequence[str] | DataFrame | None) -> DataFrame:
    """``(q_idx, query, total, unique_cnt, new_cnt)`` per query, zeros for queries without hits.

    An id occurs at most once per query, so its first and last query say whether it is exclusive and
    for whom it is new. Both aggregates combine before the shuffle, so no id is hot.
    """
    per_query = hits.groupBy("q_idx", "query").agg(F.count("*").alias("total"))
    posts = hits.groupBy("id").agg(F.min("q_idx").alias("q_idx"), F.max("q_idx").alias("_latest"))
    firsts = posts.groupBy("q_idx").agg(
        F.count("*").alias("new_cnt"), F.count_if(F.col("_latest") == F.col("q_idx")).alias("unique_cnt")
    )
    zero = [F.coalesce(c, F.lit(0)).alias(c) for c in ("unique_cnt", "new_cnt")]
    counts = per_query.join(firsts, "q_idx", "left").select("q_idx", "query", "total", *zero)
    if queries is None:
        return counts
    asked = queries if isinstance(queries, DataFrame) else query_list(hits.sparkSession, queries)
    zero = [F.coalesce(c, F.lit(0)).alias(c) for c in ("total", "unique_cnt", "new_cnt")]
    return asked.join(counts, ["q_idx", "query"], "left").select("q_idx", "query", *zero)


def query_stats(hits: DataFrame, queries: Sequence[str] | DataFrame | None = None) -> DataFrame:
    """Hits per query, and how many of them no other query found.

    ``queries`` adds those that found nothing.
    """
    return _counts(hits, queries).select("q_idx", "query", "total", "unique_cnt")


def search_new_in_order(hits: DataFrame, queries: Sequence[str] | DataFrame | None = None) -> DataFrame:
    """How many posts each query adds to those of the queries before it."""
    return _counts(hits, queries).select("q_idx", "query", "new_cnt")


def run_manifest(
    hits: DataFrame, run_ts: Column | str, queries: Sequence[str] | DataFrame | None = None
) -> DataFrame:
    """One row ``(timestamp, total_posts, queries)``; ``queries`` lists the stats in query order.

    Every distinct post is new for exactly one query, so the total needs no second pass over ids. For a
    table of queries, which may be long, the row has no list; :func:`query_stats` gives those as rows.
    """
    entry = F.struct(
        F.col("query"), F.col("total").alias("posts_collected"), F.col("unique_cnt").alias("unique_posts")
    )
    stamp = F.date_format(F.lit(run_ts).cast("timestamp"), "yyyy-MM-dd HH:mm:ss")
    total = F.coalesce(F.sum("new_cnt"), F.lit(0)).alias("total_posts")
    if isinstance(queries, DataFrame):
        return _counts(hits, queries).agg(total).select(stamp.alias("timestamp"), "total_posts")
    listed = F.array_sort(F.collect_list(F.struct(F.col("q_idx"), entry.alias("entry"))))
    totals = _counts(hits, queries).agg(total, F.transform(listed, lambda e: e["entry"]).alias("queries"))
    return totals.select(stamp.alias("timestamp"), "total_posts", "queries")
