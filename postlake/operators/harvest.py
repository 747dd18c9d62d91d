"""Replaying the page loop of a paged harvest over captured pages.

The loop takes the pages of a query in order until it has ``limit`` new posts, a page carries no
continuation token, or a page is empty (``tolerant``: the second empty page in a row). So a page is
accepted when the pages before it hold fewer than ``limit`` new posts and none of them stopped the
loop; a post is new on the first page of its query that holds it.

Running sums over all pages of a query would put a query with very many pages into one task. They
are taken inside chunks of pages, and once more over one summary row per chunk, from a stored table
of one row per page.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postlake.functions import post_key, present
from postlake.operators.posts import with_key
from postlake.operators.ranking import first_per_key
from postlake.session import shared_folder

_CHUNK_PAGES = 1024
_PAGE = ["query", "page_no"]
_CHUNK = ["query", "chunk"]


def _or_false(flag: Column) -> Column:
    return F.coalesce(flag, F.lit(False))


def _stored(frame: DataFrame, purpose: str) -> DataFrame:
    path = shared_folder(frame.sparkSession, purpose)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def _keyed(posts: DataFrame) -> DataFrame:
    """``(query, page_no, _key)``; a post without id and permalink has no key."""
    permalink = F.col("permalink") if "permalink" in posts.columns else F.lit(None).cast("string")
    return posts.select(*_PAGE, F.nullif(post_key(F.col("id"), permalink), F.lit("")).alias("_key"))


def _captured_pages(headers: DataFrame, posts: DataFrame) -> DataFrame:
    """``(query, page_no, after_token, is_empty, new_cnt)``, stored: headers and posts are read once each.

    Posts are dealt out by query and key, those without a key by page, and combined per page there; a
    key's first page is that of its new post. Headers and post counts then meet in one aggregation.
    """
    keyed = _keyed(posts)
    own_page = F.when(F.col("_key").isNull(), F.col("page_no"))
    dealt = keyed.withColumn("_spread", own_page).groupBy("query", "_key", "_spread", "page_no").agg(
        F.count("*").alias("_rows")
    )
    first = F.min("page_no").over(Window.partitionBy("query", "_key", "_spread"))
    new = (F.col("_key").isNotNull() & (F.col("page_no") == first)).cast("bigint")
    held = dealt.select(*_PAGE, F.lit(None).cast("string").alias("after_token"), "_rows", new.alias("_new"))
    zero = F.lit(0).cast("bigint")
    listed = headers.select(*_PAGE, F.col("after_token").cast("string"), F.lit(None).cast("bigint").alias("_rows"), zero.alias("_new"))
    pages = held.unionByName(listed).groupBy(*_PAGE).agg(
        F.max("after_token").alias("after_token"),
        F.coalesce(F.sum("_rows"), zero).alias("_held"),
        F.sum("_new").alias("new_cnt"),
        F.max(F.col("_rows").isNull()).alias("_listed"),
    )
    captured = pages.filter("_listed").select(*_PAGE, "after_token", (F.col("_held") == 0).alias("is_empty"), "new_cnt")
    return _stored(captured, "captured-pages")


def _with_running(pages: DataFrame, tolerant: bool) -> DataFrame:
    """Add the chunk, and what the earlier pages of the same chunk add up to."""
    inside = Window.partitionBy(*_CHUNK).orderBy("page_no")
    earlier = inside.rowsBetween(Window.unboundedPreceding, -1)
    stops_if_empty = _or_false(F.lag("is_empty").over(inside)) if tolerant else F.lit(True)
    return (
        pages.withColumn("chunk", F.floor(F.col("page_no") / _CHUNK_PAGES))
        .withColumn("_stops", ~present(F.col("after_token")) | (F.col("is_empty") & stops_if_empty))
        .withColumn("_new_before", F.coalesce(F.sum("new_cnt").over(earlier), F.lit(0)))
        .withColumn("_stopped", _or_false(F.max("_stops").over(earlier)))
    )


def _chunk_starts(running: DataFrame, tolerant: bool) -> DataFrame:
    """Per chunk: new posts and a stop before it, and whether its first page is a second empty one."""
    chunks = running.groupBy(*_CHUNK).agg(
        F.sum("new_cnt").alias("_new"),
        F.max("_stops").alias("_stops_inside"),
        F.min("page_no").alias("_first"),
        F.min_by("is_empty", "page_no").alias("_opens_empty"),
        F.max_by("is_empty", "page_no").alias("_ends_empty"),
    )
    linked = Window.partitionBy("query").orderBy("chunk")
    earlier = linked.rowsBetween(Window.unboundedPreceding, -1)
    second_empty = F.col("_opens_empty") & _or_false(F.lag("_ends_empty").over(linked)) & F.lit(tolerant)
    return (
        chunks.withColumn("_second_empty", second_empty)
        .withColumn("_stops_any", F.col("_stops_inside") | F.col("_second_empty"))
        .select(
            *_CHUNK,
            "_first",
            "_second_empty",
            F.coalesce(F.sum("_new").over(earlier), F.lit(0)).alias("_new_earlier"),
            _or_false(F.max("_stops_any").over(earlier)).alias("_stopped_earlier"),
        )
    )


def harvest_replay(headers: DataFrame, posts: DataFrame, limit: int, mode: str = "strict") -> DataFrame:
    """``(query, page_no, new_cnt, accepted)`` for every captured page.

    ``headers`` is ``(query, page_no, after_token)``, ``posts`` is ``(query, page_no, id[, permalink])``.
    """
    tolerant = _is_tolerant(mode)
    return _replayed(_captured_pages(headers, posts), limit, tolerant)


def _is_tolerant(mode: str) -> bool:
    if mode not in ("strict", "tolerant"):
        raise ValueError("mode is 'strict' or 'tolerant'")
    return mode == "tolerant"


def _replayed(pages: DataFrame, limit: int, tolerant: bool) -> DataFrame:
    """``(query, page_no, new_cnt, accepted)`` from the captured pages."""
    running = _with_running(pages, tolerant)
    stopped = (
        F.col("_stopped")
        | F.col("_stopped_earlier")
        | (F.col("_second_empty") & (F.col("page_no") > F.col("_first")))
    )
    accepted = (F.col("_new_earlier") + F.col("_new_before") < limit) & ~stopped
    return running.join(_chunk_starts(running, tolerant), _CHUNK).select(
        *_PAGE, "new_cnt", accepted.alias("accepted")
    )


def harvest_shared(
    headers: DataFrame,
    posts: DataFrame,
    queries: DataFrame,
    limit: int,
    mode: str = "strict",
    seen: DataFrame | None = None,
) -> DataFrame:
    """``(q_idx, query, page_no, new_cnt, accepted)`` when the queries, in order, share what they have seen.

    A post then counts towards a query's limit only if no earlier query collected it, so which pages a
    query takes depends on the queries before it; ``seen`` is a table of ids known from the start, and
    ``queries`` is ``(q_idx, query)``, of which a repeated text keeps its first place.

    Pages that earlier queries take add to what is seen, and the more is seen the further a query reads.
    So starting without any taken page and taking pages again by what the last round took, the taken
    pages only grow, and the round that adds none is the answer; a round settles one more query at
    least, and usually most of them. Every round is two joins on the stored first pages of posts, and a
    stored table of taken pages; the driver sees one count a round.
    """
    tolerant = _is_tolerant(mode)
    asked = queries.groupBy("query").agg(F.min("q_idx").alias("q_idx"))
    pages = _captured_pages(headers.join(asked, "query", "left_semi"), posts).drop("new_cnt")
    firsts = _keyed(posts).filter("_key IS NOT NULL").groupBy("query", "_key").agg(F.min("page_no").alias("page_no"))
    if seen is not None:
        firsts = firsts.join(seen.select(F.col("id").alias("_key")), "_key", "left_anti")
    firsts = _stored(firsts.join(asked, "query"), "first-pages")
    numbered = _stored(pages.join(asked, "query"), "query-pages")
    taken, count = None, -1
    while True:
        replayed = _replayed(_with_unseen(numbered, firsts, taken), limit, tolerant).join(asked, "query")
        replayed = _stored(replayed.select("q_idx", *_PAGE, "new_cnt", "accepted"), "shared-pages")
        taken = replayed.filter("accepted").select(*_PAGE)
        before, count = count, taken.count()
        if count == before:
            return replayed


def _with_unseen(pages: DataFrame, firsts: DataFrame, taken: DataFrame | None) -> DataFrame:
    """Pages with ``new_cnt``, the posts first on them that no earlier query collected on its ``taken`` pages."""
    open_ = firsts
    if taken is not None:
        owners = firsts.join(taken, _PAGE, "left_semi").groupBy("_key").agg(F.min("q_idx").alias("_owner"))
        open_ = firsts.join(owners, "_key", "left").filter("_owner IS NULL OR _owner >= q_idx")
    counts = open_.groupBy(*_PAGE).agg(F.count("*").alias("new_cnt"))
    zero = F.lit(0).cast("bigint")
    return pages.join(counts, _PAGE, "left").withColumn("new_cnt", F.coalesce("new_cnt", zero))


def harvest_shared_hits(
    headers: DataFrame,
    posts: DataFrame,
    queries: DataFrame,
    limit: int,
    mode: str = "strict",
    seen: DataFrame | None = None,
) -> DataFrame:
    """The posts that :func:`harvest_shared` collects: ``(q_idx, query, id, page_no, pos)``, each of them once."""
    taken = harvest_shared(headers, posts, queries, limit, mode, seen).filter("accepted").select("q_idx", *_PAGE)
    collected = with_key(posts).join(taken, _PAGE).select("q_idx", "query", F.col("key").alias("id"), "page_no", "pos")
    if seen is not None:
        collected = collected.join(seen.select("id"), "id", "left_anti")
    return first_per_key(collected, ["id"], ["q_idx", "page_no", "pos"]).select("q_idx", "query", "id", "page_no", "pos")


def harvest_hits(
    headers: DataFrame, posts: DataFrame, queries: DataFrame, limit: int, mode: str = "strict"
) -> DataFrame:
    """The posts a harvest collects: ``(q_idx, query, id, page_no, pos)``, each once per query.

    ``id`` is the post's key and ``pos`` its place on the page. The rows feed ``search_multi`` (ordered
    by query, page and place) and ``query_stats``. A page bounds the rows per join key.
    """
    accepted = harvest_replay(headers, posts, limit, mode).filter("accepted AND new_cnt > 0").select(*_PAGE)
    collected = with_key(posts).join(accepted, _PAGE, "left_semi").select("query", "key", "page_no", "pos")
    firsts = first_per_key(collected, ["query", "key"], ["page_no", "pos"])
    return firsts.join(queries, "query").select("q_idx", "query", F.col("key").alias("id"), "page_no", "pos")
