"""The registered queries: every operator run over the whole of the given tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import timedelta
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postlake import sources
from postlake.functions import normalize_endpoint
from postlake.operators import enrichment, harvest, health, pool, posts, search
from postlake.operators.ranking import dedupe_first_seen
from postlake.operators.state_changes import state_changes as changes_of
from postlake.operators.state_changes import states_at
from postlake.plans import tables
from postlake.session import shared_folder
from postlake.sources.readers import page_headers
from postlake.plans import run
from postlake.streaming import (
    drain_to_parquet, history_so_far, stream_endpoint_history, stream_enrich, stream_enrich_late, stream_health_ledger,
    stream_kept_ledger, stream_kept_states, stream_pool_state,
    stream_state_changes,
)
from postlake.streaming import stream_dedup_posts as dedup_stream

TERMS = ("the", "and", "dans", "der")
ACCENTED = ("für", "la Réeux", "ñ")
LIMIT = 100
PAGE_SIZE = 30
HARVEST_LIMIT = 25
SHARED_LIMIT = 15
CHECKS = 20
POOL_TARGET = 100
RULES = {"cooldown_base": timedelta(days=1), "dead_after": 3}
SEEDED_AT = "2024-06-01 00:00:00"
RUN_AT = "2024-06-01 12:00:00"

Query = Callable[[SparkSession, str], DataFrame]


def _micros(column: str) -> Column:
    return F.unix_micros(column).alias(f"{column}_us")


def _now() -> Column:
    return F.lit(SEEDED_AT).cast("timestamp")


def _ledger(df: DataFrame) -> DataFrame:
    return df.select("endpoint", _micros("last_ok"), "ok_streak", "fail_streak")


def _states(df: DataFrame) -> DataFrame:
    return df.select("endpoint", "state", "failures", _micros("ready_at"))


# Posts and search ------------------------------------------------------------------------------


def normalize_posts(spark: SparkSession, folder: str) -> DataFrame:
    return posts.normalize_posts(tables.posts_raw(spark, folder))


def dedup_posts(spark: SparkSession, folder: str) -> DataFrame:
    return posts.dedup_posts(tables.posts_raw(spark, folder), ["doc_id"]).select("key", "doc_id")


def _hits(spark: SparkSession, folder: str) -> DataFrame:
    return search.keyword_search(tables.documents(spark, folder), TERMS, LIMIT)


def keyword_search(spark: SparkSession, folder: str) -> DataFrame:
    return _hits(spark, folder).select(F.col("query").alias("term"), "id", "tf", "pos")


def search_page(spark: SparkSession, folder: str) -> DataFrame:
    paged = search.search_page(_hits(spark, folder), PAGE_SIZE)
    return paged.select(F.col("query").alias("term"), "page_no", "id", "next_token")


def search_multi(spark: SparkSession, folder: str) -> DataFrame:
    owned = search.search_multi(_hits(spark, folder))
    return owned.select("id", F.col("query").alias("first_term"), "q_idx")


def query_stats(spark: SparkSession, folder: str) -> DataFrame:
    return search.query_stats(_hits(spark, folder), TERMS).select(F.col("query").alias("term"), "total", "unique_cnt")


def search_new_in_order(spark: SparkSession, folder: str) -> DataFrame:
    return search.search_new_in_order(_hits(spark, folder), TERMS).select(F.col("query").alias("term"), "new_cnt")


def run_manifest(spark: SparkSession, folder: str) -> DataFrame:
    manifest = search.run_manifest(_hits(spark, folder), RUN_AT, TERMS)
    return manifest.select("timestamp", "total_posts", F.to_json("queries").alias("queries_json"))


def harvest_replay(spark: SparkSession, folder: str, mode: str) -> DataFrame:
    return harvest.harvest_replay(
        tables.page_headers(spark, folder), tables.page_posts(spark, folder), HARVEST_LIMIT, mode
    )


def _by_source(headers: DataFrame) -> DataFrame:
    """The queries of captured pages, numbered as the sources they stand for."""
    return headers.select("query").distinct().withColumn("q_idx", F.expr("CAST(substring(query, 4) AS INT)"))


def _harvest_hits(spark: SparkSession, folder: str) -> DataFrame:
    headers = tables.page_headers(spark, folder)
    return harvest.harvest_hits(headers, tables.page_posts(spark, folder), _by_source(headers), HARVEST_LIMIT)


def harvest_hits(spark: SparkSession, folder: str) -> DataFrame:
    return _harvest_hits(spark, folder)


def harvest_stats(spark: SparkSession, folder: str) -> DataFrame:
    hits = _harvest_hits(spark, folder)
    owned = search.search_multi(hits, ("q_idx", "page_no", "pos")).groupBy("query").agg(F.count("*").alias("owned"))
    stats = search.query_stats(hits).select("query", "total", "unique_cnt")
    return stats.join(owned, "query", "left").withColumn("owned", F.coalesce("owned", F.lit(0)))


def harvest_shared(spark: SparkSession, folder: str, mode: str = "strict") -> DataFrame:
    """Queries in order that count only posts which no earlier one, and no earlier run, has collected."""
    headers = tables.page_headers(spark, folder)
    return harvest.harvest_shared(
        headers, tables.shared_page_posts(spark, folder), _by_source(headers), SHARED_LIMIT, mode, tables.seen_posts(spark, folder)
    )


def harvest_shared_hits(spark: SparkSession, folder: str) -> DataFrame:
    headers = tables.page_headers(spark, folder)
    return harvest.harvest_shared_hits(
        headers, tables.shared_page_posts(spark, folder), _by_source(headers), SHARED_LIMIT, seen=tables.seen_posts(spark, folder)
    )


def ingest_search_pages(spark: SparkSession, folder: str) -> DataFrame:
    return sources.ingest_search_pages(tables.search_pages(spark, folder))


def search_page_headers(spark: SparkSession, folder: str) -> DataFrame:
    return page_headers(tables.search_pages(spark, folder))


def keyword_search_accents(spark: SparkSession, folder: str) -> DataFrame:
    hits = search.keyword_search(tables.documents(spark, folder), ACCENTED, LIMIT)
    return hits.select(F.col("query").alias("term"), "id", "tf", "pos")


def search_page_from_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """Two queries go on behind the last post of their first page, the others start at the first."""
    hits = _hits(spark, folder)
    tokens = hits.filter((F.col("pos") == PAGE_SIZE) & (F.col("q_idx") <= 2)).select("query", F.col("id").alias("after"))
    paged = search.search_page(hits, PAGE_SIZE, tokens)
    return paged.select(F.col("query").alias("term"), "page_no", "id", "next_token")


def harvest_run(spark: SparkSession, folder: str) -> DataFrame:
    """The posts that a whole run over captured pages writes, with the run's total."""
    work = shared_folder(spark, "harvest-run")
    run.harvest_run(tables.query_pages(spark, folder), work, "run-1", RUN_AT, HARVEST_LIMIT)
    return _written_run(spark, work)


def harvest_run_recaptured(spark: SparkSession, folder: str) -> DataFrame:
    """The same run from pages captured several times: the latest readable capture of each counts."""
    work = shared_folder(spark, "harvest-run")
    run.harvest_run(tables.query_page_captures(spark, folder), work, "run-1", RUN_AT, HARVEST_LIMIT)
    return _written_run(spark, work)


def rejected_pages(spark: SparkSession, folder: str) -> DataFrame:
    return sources.rejected_pages(tables.query_page_captures(spark, folder)).select("query", "page_no", "fetched_at", "reason")


def _written_run(spark: SparkSession, work: str) -> DataFrame:
    written = spark.read.parquet(f"{work}/posts")
    manifest = spark.read.parquet(f"{work}/runs").select("run_id", "total_posts")
    return written.join(manifest, "run_id").select("query", "page_no", "pos", *posts.POST_FIELDS, "total_posts")


# Details and enrichment ------------------------------------------------------------------------


def flatten_comments(spark: SparkSession, folder: str) -> DataFrame:
    comments = enrichment.flatten_comments(tables.details_raw(spark, folder))
    path = F.array_join("path", ".").alias("path")
    return comments.select("doc_id", path, "depth", "author", "body", "score")


def nest_comments(spark: SparkSession, folder: str) -> DataFrame:
    return enrichment.nest_comments(tables.details_raw(spark, folder))


def comment_stats(spark: SparkSession, folder: str) -> DataFrame:
    return enrichment.thread_stats(tables.details_raw(spark, folder)).select("doc_id", "n_comments", "max_depth")


def _details(spark: SparkSession, folder: str) -> DataFrame:
    return enrichment.latest_details(tables.detail_captures(spark, folder).drop("doc_id"))


def rejected_details(spark: SparkSession, folder: str) -> DataFrame:
    captured = enrichment.rejected_details(tables.detail_captures(spark, folder))
    return captured.select("doc_id", "fetched_at", "reason")


def detail_worklist(spark: SparkSession, folder: str) -> DataFrame:
    left = enrichment.detail_worklist(tables.posts_raw(spark, folder), _details(spark, folder))
    return left.select("doc_id", "detail_url")


def _enriched(spark: SparkSession, folder: str) -> DataFrame:
    return enrichment.enrich_posts(tables.posts_raw(spark, folder), _details(spark, folder))


def enrich_posts(spark: SparkSession, folder: str) -> DataFrame:
    return _enriched(spark, folder).select("doc_id", "body", "n_comments", "has_details")


def enrichment_summary(spark: SparkSession, folder: str) -> DataFrame:
    return enrichment.enrichment_summary(_enriched(spark, folder))


def enrichment_failures(spark: SparkSession, folder: str) -> DataFrame:
    return enrichment.failed_posts(_enriched(spark, folder)).select("doc_id", F.col("id").alias("failed_id"))


def detail_worklist_enriched(spark: SparkSession, folder: str) -> DataFrame:
    """The worklist of a second round, whose posts say which of them have details."""
    enriched = _enriched(spark, folder).select("doc_id", "permalink", "has_details")
    nothing = enriched.select("permalink").limit(0)
    return enrichment.detail_worklist(enriched, nothing).select("doc_id", "detail_url")


def enriched_document_head(spark: SparkSession, folder: str) -> DataFrame:
    """What the summary at the head of written documents says, and how many posts they hold."""
    path = shared_folder(spark, "document-head")
    normal = posts.normalize_posts(tables.posts_raw(spark, folder))
    enriched = enrichment.enrich_posts(normal, _details(spark, folder))
    summary = enrichment.enrichment_summary(enriched).select(F.to_json(F.struct("*"))).first()[0]
    sources.write_enriched(enriched, path, metadata_json='{"source":"harvest"}', summary_json=summary)
    head = lambda name: F.get_json_object("value", f"$.enrichment_summary.{name}").cast("bigint").alias(name)
    written = spark.read.text(path)
    listed = F.size(F.from_json(F.get_json_object("value", "$.posts"), "array<struct<name:string>>")).alias("_posts")
    heads = written.select(head("total"), head("success"), head("failed"), listed)
    return heads.groupBy("total", "success", "failed").agg(F.sum("_posts").alias("n_posts"))


# Endpoint lists, health and ledger ---------------------------------------------------------------


def normalize_endpoints(spark: SparkSession, folder: str) -> DataFrame:
    lines = tables.endpoint_lines(spark, folder)
    return lines.select("pos", F.col("line").alias("raw"), normalize_endpoint(F.col("line")).alias("endpoint"))


def _listed(spark: SparkSession, folder: str) -> DataFrame:
    return pool.parse_endpoints(tables.endpoint_lines(spark, folder))


def load_endpoints(spark: SparkSession, folder: str) -> DataFrame:
    path = shared_folder(spark, "endpoint-list")
    lines = tables.endpoint_lines(spark, folder).orderBy("pos").select("line")
    lines.write.text(path)
    return sources.load_endpoints(spark, path)


def merge_sources(spark: SparkSession, folder: str) -> DataFrame:
    lines = tables.endpoint_lines(spark, folder)
    return pool.merge_sources([lines.filter(F.col("src_idx") == i) for i in range(3)])


def load_sources(spark: SparkSession, folder: str) -> DataFrame:
    """Endpoints of three list files, the second of which isn't there, by the files that could be read."""
    path = shared_folder(spark, "sources")
    lines = tables.endpoint_lines(spark, folder)
    for i in (0, 2):
        lines.filter(F.col("src_idx") == i).orderBy("pos").select("line").write.text(f"{path}/{i}")
    listed, status = sources.load_sources(spark, [f"{path}/{i}" for i in range(3)])
    return listed.join(status.select("src_idx", "ok"), "src_idx").select("endpoint", "src_idx", "ok")


def classify_failure(spark: SparkSession, folder: str) -> DataFrame:
    return health.failure_kinds(tables.failure_log(spark, folder))


def split_ok_failed(spark: SparkSession, folder: str) -> DataFrame:
    return health.split_ok_failed(tables.request_log(spark, folder))


def first_n_passing(spark: SparkSession, folder: str) -> DataFrame:
    return health.first_n_passing(tables.request_log(spark, folder), CHECKS).select("event_id", "ok")


def failure_streaks(spark: SparkSession, folder: str) -> DataFrame:
    return health.failure_streaks(tables.request_log(spark, folder))


def health_ledger(spark: SparkSession, folder: str) -> DataFrame:
    return _ledger(health.health_ledger(tables.request_log(spark, folder)))


def pool_state(spark: SparkSession, folder: str) -> DataFrame:
    return _states(health.pool_state(tables.request_log(spark, folder), **RULES))


def pool_stats(spark: SparkSession, folder: str) -> DataFrame:
    return health.pool_stats(health.pool_state(tables.request_log(spark, folder), **RULES))


def _changes(df: DataFrame) -> DataFrame:
    return df.select("endpoint", _micros("at"), "state", "failures", _micros("ready_at"))


def state_changes(spark: SparkSession, folder: str) -> DataFrame:
    return _changes(changes_of(tables.request_log(spark, folder), **RULES))


def states_replayed(spark: SparkSession, folder: str) -> DataFrame:
    """The states at the end of the log, from the changes up to then."""
    log = tables.request_log(spark, folder)
    return _states(states_at(changes_of(log, **RULES), log.agg(F.max("ts")).scalar()))


def _good(spark: SparkSession, folder: str) -> DataFrame:
    passed = health.first_n_passing(tables.request_log(spark, folder), CHECKS).filter("ok")
    return dedupe_first_seen(passed.select("endpoint", F.col("event_id").alias("pos")), "endpoint", ["pos"])


def refresh_pool(spark: SparkSession, folder: str) -> DataFrame:
    return pool.refresh_pool(_good(spark, folder), _listed(spark, folder), POOL_TARGET).select("endpoint", "rank")


def upsert_ledger(spark: SparkSession, folder: str) -> DataFrame:
    ledger = health.health_ledger(tables.request_log(spark, folder))
    return _ledger(pool.upsert_ledger(ledger, _listed(spark, folder), _now()))


def refresh_ledger(spark: SparkSession, folder: str) -> DataFrame:
    ledger = health.health_ledger(tables.request_log(spark, folder))
    members = pool.refresh_pool(_good(spark, folder), _listed(spark, folder), POOL_TARGET)
    return _ledger(pool.refresh_ledger(ledger, members, _now()))


def append_if_absent(spark: SparkSession, folder: str) -> DataFrame:
    """Endpoints of the first source, then those of the other two that it lacks."""
    lines = tables.endpoint_lines(spark, folder)
    target = pool.parse_endpoints(lines.filter("src_idx = 0")).select("endpoint")
    found = pool.parse_endpoints(lines.filter("src_idx <> 0")).select("endpoint")
    return pool.append_if_absent(target, found, "endpoint")


# Sinks, read back ----------------------------------------------------------------------------------


def read_posts_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Posts with a permalink in documents with metadata, the others in bare lists; both read back."""
    path = shared_folder(spark, "documents")
    normal = posts.normalize_posts(tables.posts_raw(spark, folder))
    linked = F.length("permalink") > 0
    sources.write_documents(normal.filter(linked), f"{path}/with", metadata_json='{"source":"harvest"}')
    sources.write_documents(normal.filter(~linked), f"{path}/bare")
    back = sources.read_posts(spark, [f"{path}/with", f"{path}/bare"], multi_line=False)
    return back.select(*posts.POST_FIELDS, "has_details")


def write_enriched_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    path = shared_folder(spark, "enriched")
    raw = tables.posts_raw(spark, folder)
    normal = posts.normalize_posts(raw, keep=["doc_id"])
    details = enrichment.latest_details(tables.detail_captures(spark, folder).drop("doc_id"), with_comments=True)
    enriched = enrichment.enrich_posts(normal, details, with_comments=True)
    sources.write_enriched(enriched, path, metadata_json='{"source":"harvest"}')
    back = sources.read_posts(spark, path, multi_line=False)
    top_level = F.size(F.try_variant_get("comments", "$", "array<variant>")).cast("bigint")
    return back.select("name", "body", F.when(F.col("has_details"), top_level).alias("top_comments"), "has_details")


def large_document_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Enriched posts written as one document of many files, summary first, and read back by splits."""
    path = shared_folder(spark, "large-document")
    normal = posts.normalize_posts(tables.posts_raw(spark, folder), keep=["doc_id"])
    details = enrichment.latest_details(tables.detail_captures(spark, folder).drop("doc_id"), with_comments=True)
    enriched = enrichment.enrich_posts(normal, details, with_comments=True)
    head = {"metadata_json": '{"source":"harvest","queries":[{"posts":[]}]}', "summary_json": '{"note":"}"}'}
    sources.write_large_document(enriched, path, ["doc_id"], enriched=True, **head)
    back = sources.read_large_posts(spark, path, whole=True)
    top_level = F.size(F.try_variant_get("comments", "$", "array<variant>")).cast("bigint")
    return back.select("name", "body", F.when(F.col("has_details"), top_level).alias("top_comments"), "has_details")


def write_run_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Deduplicated posts of a run, written per run and read back."""
    path = shared_folder(spark, "runs")
    _hits(spark, folder).write.parquet(f"{path}/hits")
    hits = spark.read.parquet(f"{path}/hits")
    sources.write_run(search.search_multi(hits), search.run_manifest(hits, RUN_AT, TERMS), path, "run-1")
    written = spark.read.parquet(f"{path}/posts")
    manifest = spark.read.parquet(f"{path}/runs").select("run_id", "total_posts")
    return written.join(manifest, "run_id").select(
        "run_id", F.col("query").alias("first_term"), "id", "doc_id", "tf", "pos", "total_posts"
    )


def ledger_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    path = shared_folder(spark, "ledger")
    sources.write_ledger(health.health_ledger(tables.request_log(spark, folder)), path)
    return sources.read_ledger(spark, path)


# Streams -------------------------------------------------------------------------------------------

_STREAM_SLICES = 4


def _as_stream(
    source: DataFrame, time: str, folder: str, order: Sequence[int] = range(_STREAM_SLICES)
) -> tuple[DataFrame, timedelta]:
    """Write a table as files of time slices in the given order, read it as a stream of some slice a batch.

    A slice has as many files as a shuffle has partitions, so many tasks write and read it. Also gives the
    length of a time slice. An empty table is a stream of one empty batch.
    """
    spark = source.sparkSession
    files = int(spark.conf.get("spark.sql.shuffle.partitions"))
    low, high = source.agg(F.min(time), F.max(time)).first()
    if low is None:
        source.limit(0).write.parquet(folder)
        return spark.readStream.schema(source.schema).parquet(folder), timedelta(seconds=1)
    width = (high - low) / _STREAM_SLICES + timedelta(microseconds=1)
    for i in order:
        begin, end = F.lit(low + i * width), F.lit(low + (i + 1) * width)
        part = source.filter((F.col(time) >= begin) & (F.col(time) < end))
        part.repartition(files).write.mode("append").parquet(folder)
    return spark.readStream.schema(source.schema).option("maxFilesPerTrigger", files).parquet(folder), width


def stream_dedup_posts(spark: SparkSession, folder: str) -> DataFrame:
    """Posts with copies in later batches and without keys; the delay spans them all."""
    work = shared_folder(spark, "stream-dedup")
    posts_in = tables.posts_raw(spark, folder).select("id", "permalink", F.timestamp_seconds("created_utc").alias("at"))
    stream, width = _as_stream(posts_in, "at", f"{work}/in")
    kept = dedup_stream(stream, "at", f"{int(width.total_seconds() * _STREAM_SLICES) + 1} seconds")
    return drain_to_parquet(kept, work).select("key")


def stream_ledger(spark: SparkSession, folder: str) -> DataFrame:
    work = shared_folder(spark, "stream-ledger")
    stream, width = _as_stream(tables.request_log(spark, folder), "ts", f"{work}/in")
    return _ledger(stream_health_ledger(stream, work, width))


def stream_states(spark: SparkSession, folder: str) -> DataFrame:
    work = shared_folder(spark, "stream-states")
    stream, width = _as_stream(tables.request_log(spark, folder), "ts", f"{work}/in")
    return _states(stream_pool_state(stream, work, width, **RULES))


def stream_changes(spark: SparkSession, folder: str) -> DataFrame:
    """Slices in order and no delay, so that the clock stands at the newest request."""
    work = shared_folder(spark, "stream-changes")
    stream, _ = _as_stream(tables.request_log(spark, folder), "ts", f"{work}/in")
    return _changes(stream_state_changes(stream, work, timedelta(0), **RULES))


def stream_enriched(spark: SparkSession, folder: str) -> DataFrame:
    work = shared_folder(spark, "stream-enrich")
    _details(spark, folder).select("permalink", "body", "n_comments").write.parquet(f"{work}/details")
    raw = tables.posts_raw(spark, folder).withColumn("at", F.timestamp_seconds("created_utc"))
    stream, _ = _as_stream(raw, "at", f"{work}/in")
    done = stream_enrich(stream, spark.read.parquet(f"{work}/details"), work, ("created_utc", "doc_id"))
    return done.select("doc_id", "body", "n_comments", "has_details")


def stream_enriched_late(spark: SparkSession, folder: str) -> DataFrame:
    """Posts in order of time while their details come in the opposite order."""
    work = shared_folder(spark, "stream-enrich-late")
    raw = tables.posts_raw(spark, folder).withColumn("at", F.timestamp_seconds("created_utc"))
    posts_in, _ = _as_stream(raw, "at", f"{work}/posts")
    read = enrichment.latest_details(tables.detail_captures(spark, folder))
    read = read.select("permalink", "body", "n_comments", F.timestamp_seconds("doc_id").alias("at"))
    read.write.parquet(f"{work}/read")
    read = spark.read.schema(read.schema).parquet(f"{work}/read")
    details_in, _ = _as_stream(read, "at", f"{work}/details", order=range(_STREAM_SLICES)[::-1])
    done = stream_enrich_late(posts_in, details_in, work, ("created_utc", "doc_id"))
    return done.select("doc_id", "body", "n_comments", "has_details")


def _arriving(spark: SparkSession, folder: str, work: str) -> DataFrame:
    """The request log as a stream in which every third request comes up to three days late, by its id."""
    log = tables.request_log(spark, folder)
    seconds = F.when(F.col("event_id") % 3 == 0, F.pmod(F.xxhash64("event_id"), F.lit(3 * 86_400))).otherwise(0)
    stream, _ = _as_stream(log.withColumn("at", F.timestamp_add("SECOND", seconds, F.col("ts"))), "at", f"{work}/in")
    return stream


def kept_ledger(spark: SparkSession, folder: str) -> DataFrame:
    """The ledger kept in place, exact though a third of the requests comes late."""
    work = shared_folder(spark, "kept-ledger")
    return _ledger(stream_kept_ledger(_arriving(spark, folder, work), work))


def kept_states(spark: SparkSession, folder: str) -> DataFrame:
    work = shared_folder(spark, "kept-states")
    return _states(stream_kept_states(_arriving(spark, folder, work), work, **RULES))


def stream_late_ledger(spark: SparkSession, folder: str) -> DataFrame:
    """Time slices out of order and no delay, so that half of the rows come behind the watermark."""
    work = shared_folder(spark, "stream-late")
    stream, _ = _as_stream(tables.request_log(spark, folder), "ts", f"{work}/in", order=(1, 0, 3, 2))
    stream_endpoint_history(stream, work, timedelta(0))
    history = history_so_far(spark, work)
    facts = health.ledger_of(history).select("endpoint", _micros("last_ok"), "ok_streak")
    return facts.join(history.select("endpoint", F.col("any_dead").alias("dead")), "endpoint")


QUERIES: dict[str, Query] = {
    "load_sources": load_sources,
    "large_document_roundtrip": large_document_roundtrip,
    "stream_enrich_late": stream_enriched_late,
    "harvest_run_recaptured": harvest_run_recaptured,
    "rejected_pages": rejected_pages,
    "harvest_shared": harvest_shared,
    "harvest_shared_tolerant": partial(harvest_shared, mode="tolerant"),
    "harvest_shared_hits": harvest_shared_hits,
    "rejected_details": rejected_details,
    "stream_late_ledger": stream_late_ledger,
    "harvest_run": harvest_run,
    "search_page_from_tokens": search_page_from_tokens,
    "keyword_search_accents": keyword_search_accents,
    "detail_worklist_enriched": detail_worklist_enriched,
    "enriched_document_head": enriched_document_head,
    "normalize_posts": normalize_posts,
    "dedup_posts": dedup_posts,
    "dedupe_first_seen": _listed,
    "keyword_search": keyword_search,
    "search_page": search_page,
    "search_multi": search_multi,
    "query_stats": query_stats,
    "search_new_in_order": search_new_in_order,
    "run_manifest": run_manifest,
    "harvest_replay": partial(harvest_replay, mode="strict"),
    "harvest_replay_tolerant": partial(harvest_replay, mode="tolerant"),
    "harvest_hits": harvest_hits,
    "harvest_stats": harvest_stats,
    "ingest_search_pages": ingest_search_pages,
    "search_page_headers": search_page_headers,
    "flatten_comments": flatten_comments,
    "nest_comments": nest_comments,
    "comment_stats": comment_stats,
    "detail_worklist": detail_worklist,
    "enrich_posts": enrich_posts,
    "enrichment_summary": enrichment_summary,
    "enrichment_failures": enrichment_failures,
    "load_endpoints": load_endpoints,
    "normalize_endpoint": normalize_endpoints,
    "merge_sources": merge_sources,
    "classify_failure": classify_failure,
    "split_ok_failed": split_ok_failed,
    "first_n_passing": first_n_passing,
    "failure_streaks": failure_streaks,
    "health_ledger": health_ledger,
    "pool_state": pool_state,
    "state_changes": state_changes,
    "states_replayed": states_replayed,
    "pool_stats": pool_stats,
    "refresh_pool": refresh_pool,
    "upsert_ledger": upsert_ledger,
    "refresh_ledger": refresh_ledger,
    "append_if_absent": append_if_absent,
    "read_posts_roundtrip": read_posts_roundtrip,
    "write_enriched_roundtrip": write_enriched_roundtrip,
    "write_run_roundtrip": write_run_roundtrip,
    "ledger_roundtrip": ledger_roundtrip,
    "stream_dedup_posts": stream_dedup_posts,
    "stream_health_ledger": stream_ledger,
    "stream_pool_state": stream_states,
    "stream_kept_ledger": kept_ledger,
    "stream_kept_states": kept_states,
    "stream_state_changes": stream_changes,
    "stream_enrich": stream_enriched,
}
