"""Readers for captured pages, post documents, endpoint lists and ledgers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from postlake.operators.pool import parse_endpoints
from postlake.operators.posts import POST_FIELDS, normalize_posts
from postlake.operators.ranking import first_per_key
from postlake.sources.schemas import DOCUMENT, LEDGER_MAP, SEARCH_PAGE


def ingest_search_pages(pages: DataFrame) -> DataFrame:
    """Post rows of captured search pages: page columns, place on the page, ``after``, post fields.

    Input is ``(payload, …)`` with one listing per row; a page without posts gives no rows, its token
    is read with :func:`page_headers`.
    """
    kept = [c for c in pages.columns if c != "payload"]
    page = pages.select(*kept, F.from_json("payload", SEARCH_PAGE).alias("_page"))
    # Only the token goes along with every post; carrying the page would copy it once per post.
    parts = page.select(*kept, F.col("_page.data.after").alias("after"), F.col("_page.data.children").alias("_children"))
    rows = parts.select(*kept, "after", F.posexplode("_children").alias("pos", "_child"))
    return normalize_posts(rows.select(*kept, "after", "pos", "_child.data.*"), keep=[*kept, "after", "pos"])


def _readable_page(payload: Column) -> Column:
    return F.coalesce(F.from_json(payload, SEARCH_PAGE)["data"]["children"].isNotNull(), F.lit(False))


def latest_pages(pages: DataFrame) -> DataFrame:
    """One capture of every ``(query, page_no)``: the latest readable one by ``fetched_at``, if there is that column.

    Of a page without any readable capture one stays; it has no token, so a replay stops behind it. Equal
    captures count once, and a page captured under two numbers of one query keeps the lower.
    """
    order = [F.desc("fetched_at")] if "fetched_at" in pages.columns else []
    numbered = [F.asc("q_idx")] if "q_idx" in pages.columns else []
    marked = pages.withColumn("_readable", _readable_page(F.col("payload"))).withColumn("_tie", F.xxhash64("payload"))
    kept = first_per_key(marked, ["query", "page_no"], [F.desc("_readable"), *order, *numbered, F.asc("_tie")])
    return kept.drop("_readable", "_tie")


def rejected_pages(pages: DataFrame) -> DataFrame:
    """``(…, reason)`` of the captures that hold no page, which is not the same as an empty one; the payload goes.

    ``json``: no JSON text; ``listing``: JSON without a list of posts.
    """
    reason = F.when(F.try_parse_json("payload").isNull(), "json").otherwise("listing")
    return pages.filter(~_readable_page(F.col("payload"))).withColumn("reason", reason).drop("payload")


def page_headers(pages: DataFrame) -> DataFrame:
    """Continuation token of every captured page, empty pages included."""
    kept = [c for c in pages.columns if c != "payload"]
    token = F.get_json_object("payload", "$.data.after")
    return pages.select(*kept, token.alias("after_token"))


def read_posts(spark: SparkSession, path: str | list[str], multi_line: bool = True) -> DataFrame:
    """Posts of documents in either shape, with ``has_details`` for already enriched ones.

    ``multi_line`` is for one (pretty-printed) document per file; ours have one document per line. A
    broken document is an error; :func:`rejected_documents` lists them.
    """
    raw = spark.read.schema(DOCUMENT).options(multiLine=multi_line, mode="FAILFAST").json(path)
    return posts_of(raw)


def posts_of(raw: DataFrame) -> DataFrame:
    """A document row becomes its posts, a bare post row stays one post."""
    fields = [*POST_FIELDS, "body", "comments"]
    listed = F.transform("posts", lambda p: F.struct(*[p[f].alias(f) for f in fields]))
    single = F.when(F.col("metadata").isNull() & F.col("enrichment_summary").isNull(), F.array(F.struct(*fields)))
    posts = raw.select(F.inline(F.coalesce(listed, single)))
    return posts.withColumn("has_details", F.col("body").isNotNull() | F.col("comments").isNotNull())


def rejected_documents(spark: SparkSession, path: str | list[str], multi_line: bool = True) -> DataFrame:
    """``(file, document)`` of the documents that :func:`read_posts` cannot parse."""
    schema = f"{DOCUMENT}, document string"
    reader = spark.read.schema(schema).options(multiLine=multi_line, columnNameOfCorruptRecord="document")
    named = reader.json(path).select("*", F.col("_metadata.file_name").alias("file"))
    # All fields are read, for a pruned read would not notice what is broken.
    fields = F.to_json(F.struct(*[F.col(c) for c in named.columns if c not in ("document", "file")]))
    return named.filter((F.length(fields) >= 0) & F.col("document").isNotNull()).select("file", "document")


def posts_of_readable_documents(spark: SparkSession, path: str | list[str], multi_line: bool = True) -> DataFrame:
    """As :func:`read_posts`, passing over the documents that :func:`rejected_documents` lists."""
    schema = f"{DOCUMENT}, document string"
    reader = spark.read.schema(schema).options(multiLine=multi_line, columnNameOfCorruptRecord="document")
    raw = reader.json(path)
    fields = F.to_json(F.struct(*[F.col(c) for c in raw.columns if c != "document"]))
    return posts_of(raw.filter((F.length(fields) >= 0) & F.col("document").isNull()).drop("document"))


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """``(pos, line)`` of text files with line numbers from 0, in file order.

    Lines are numbered inside their input split; splits are small in number, so their offsets come
    from a window over per-split counts. No file has to pass through one task.
    """
    raw = spark.read.text(path).select(
        F.col("value").alias("line"),
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_id"),
    )
    split = ["_file", "_block"]
    counts = raw.groupBy(*split).agg(F.count("*").alias("_n"), F.min("_id").alias("_first"))
    earlier = Window.orderBy(*split).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("_offset", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
    return raw.join(offsets, split).select((F.expr("_id - _first + _offset")).alias("pos"), "line")


def load_endpoints(spark: SparkSession, path: str) -> DataFrame:
    """Distinct normalised endpoints of a list file with the line they were first seen on."""
    return parse_endpoints(read_lines(spark, path))


def read_ledger(spark: SparkSession, path: str, whole_file: bool = False) -> DataFrame:
    """Ledger rows of JSON maps keyed by endpoint; unreadable text gives no rows.

    ``whole_file`` is for one (pretty-printed) map per file; ours have one map per line.
    """
    text = spark.read.text(path, wholetext=whole_file)
    entries = text.select(F.explode(F.from_json("value", LEDGER_MAP)).alias("endpoint", "_state"))
    return entries.select("endpoint", "_state.*")
