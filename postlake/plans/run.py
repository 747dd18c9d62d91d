"""Whole runs to written results: from captured posts, with enrichment if details are at hand, and from pages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlake.operators.enrichment import enrich_posts, enrichment_summary, failed_posts, latest_details
from postlake.operators.harvest import harvest_hits, harvest_shared_hits
from postlake.operators.posts import POST_FIELDS, normalize_posts, with_key
from postlake.operators.search import keyword_search, query_stats, run_manifest, search_multi
from postlake.sources.readers import ingest_search_pages, latest_pages, page_headers, rejected_pages
from postlake.sources.sinks import write_enriched, write_run


def search_run(
    posts: DataFrame,
    queries: Sequence[str],
    output: str,
    run_id: str,
    run_ts: str,
    limit_per_query: int = 100,
    details: DataFrame | None = None,
    text: str = "selftext",
    ordinal: str = "doc_id",
) -> None:
    """Search raw posts and write ``hits``, ``posts`` and ``runs`` under ``output`` for this run.

    With raw ``details`` the run's posts are also written as ``enriched`` documents, next to an
    ``enrichment`` summary and the ``failed`` ids. The hits, at most the limit per query, are written
    first: everything after them starts from that small table, so the posts are scanned once for the
    search and once, against the (size-checked, usually broadcast) hits, for their fields.
    """
    spark = posts.sparkSession
    own = f"run_id={run_id}"
    keyed = with_key(posts).select(F.col("key").alias("id"), ordinal, text)
    keyword_search(keyed, queries, limit_per_query, text, ordinal).write.mode("overwrite").parquet(f"{output}/hits/{own}")
    hits = spark.read.parquet(f"{output}/hits/{own}")
    found = search_multi(hits).select(ordinal, "q_idx", "query", "tf", "pos")
    kept = normalize_posts(posts, keep=[ordinal]).join(found, ordinal)
    write_run(kept, run_manifest(hits, run_ts, queries), output, run_id)
    if details is None:
        return
    # The run's posts pick the details worth parsing.
    stored = spark.read.parquet(f"{output}/posts/{own}")
    wanted = details.join(stored.select("permalink").distinct(), "permalink", "left_semi")
    enriched = enrich_posts(stored, latest_details(wanted, with_comments=True), with_comments=True)
    enriched.write.mode("overwrite").parquet(f"{output}/enriched_posts/{own}")
    enriched = spark.read.parquet(f"{output}/enriched_posts/{own}")
    enrichment_summary(enriched).write.mode("overwrite").parquet(f"{output}/enrichment/{own}")
    failed_posts(enriched).select("id", "permalink").write.mode("overwrite").parquet(f"{output}/failed/{own}")
    summary = enrichment_summary(enriched).select(F.to_json(F.struct("*"))).first()[0]
    write_enriched(enriched, f"{output}/enriched/{own}", metadata_json=_manifest_json(spark, output, own), summary_json=summary)


def harvest_run(
    pages: DataFrame,
    output: str,
    run_id: str,
    run_ts: str,
    limit: int,
    mode: str = "strict",
    shared: bool = False,
    seen: DataFrame | None = None,
) -> None:
    """From captured pages ``(query, q_idx, page_no, payload[, fetched_at])`` to the posts, stats and manifest of a run.

    The payloads are parsed once, into tables of posts and page headers under ``output``; replaying the
    page loop, first-seen posts and statistics start from those. A page that was captured several times
    counts once, with its latest readable capture; what is unreadable is listed in ``rejected_pages``.
    ``posts`` holds each collected post with all its fields and the earliest query that found it,
    ``stats`` the counts of every query; a repeated query counts once. With ``shared``, or a table of ids
    ``seen`` before, a query's limit counts only posts that neither an earlier query nor that table has.
    """
    spark = pages.sparkSession
    own = f"run_id={run_id}"

    def saved(frame: DataFrame, name: str) -> DataFrame:
        frame.write.mode("overwrite").parquet(f"{output}/{name}/{own}")
        return spark.read.schema(frame.schema).parquet(f"{output}/{name}/{own}")

    key = ["query", "page_no"]
    saved(rejected_pages(pages), "rejected_pages")
    once = latest_pages(pages).select(*key, "q_idx", "payload")
    queries = saved(pages.groupBy("query").agg(F.min("q_idx").alias("q_idx")), "queries").select("q_idx", "query")
    found = saved(once.select(*key, "payload").transform(ingest_search_pages), "page_posts")
    headers = saved(page_headers(once.select(*key, "payload")), "page_headers")
    if shared or seen is not None:
        collected = harvest_shared_hits(headers, found, queries, limit, mode, seen)
    else:
        collected = harvest_hits(headers, found, queries, limit, mode)
    hits = saved(collected, "hits")
    owned = search_multi(hits, ("q_idx", "page_no", "pos")).select("q_idx", "query", "page_no", "pos")
    posts = found.join(owned, ["query", "page_no", "pos"])
    saved(query_stats(hits, queries), "stats")
    write_run(posts.select("q_idx", "query", "page_no", "pos", *POST_FIELDS), run_manifest(hits, run_ts, queries), output, run_id)


def _manifest_json(spark, output: str, own: str) -> str:
    manifest = spark.read.parquet(f"{output}/runs/{own}")
    return manifest.select(F.to_json(F.struct("timestamp", "total_posts", "queries"))).first()[0]
