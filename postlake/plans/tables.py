"""Captured inputs of the engine, derived from the given tables.

The tables hold no forum captures, so each input is a projection of one: documents stand in for raw
posts, search pages and post details, events for request outcomes and endpoint lists. Payloads are
built inside the row wherever one payload belongs to one row.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PAGE_ROWS = 100


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{folder}/{name}.parquet")


def documents(spark: SparkSession, folder: str) -> DataFrame:
    """Searchable posts; copies of a text share an id."""
    return table(spark, folder, "documents").withColumn("id", F.md5("text"))


def posts_raw(spark: SparkSession, folder: str) -> DataFrame:
    """Raw posts with null and empty ids, empty permalinks and duplicate ids."""
    return table(spark, folder, "documents").selectExpr(
        "doc_id",
        "CASE WHEN doc_id % 11 = 0 THEN NULL WHEN doc_id % 13 = 0 THEN '' ELSE md5(text) END AS id",
        "concat('t3_', doc_id) AS name",
        "split_part(text, '\\n', 1) AS title",
        "source AS author",
        "concat(lang, '_', source) AS subreddit",
        "CASE WHEN doc_id % 10 = 3 THEN '' ELSE concat('/r/', lang, '/comments/', doc_id, '/') END AS permalink",
        "concat('https://example.org/', doc_id) AS url",
        "CASE WHEN doc_id % 7 = 0 THEN NULL ELSE text END AS selftext",
        "CAST(1700000000 + doc_id * 60 AS DOUBLE) AS created_utc",
        "n_chars AS score",
        "doc_id % 50 AS num_comments",
    )


def details_raw(spark: SparkSession, folder: str) -> DataFrame:
    """``(doc_id, permalink, payload)``: every text as a thread of lines, sentences and clauses.

    Every fourth line and every third clause is a stub of another kind, scores and authors are
    missing here and there, and two payloads in nine are an error object or broken JSON.
    """
    clause = """concat('{"kind":"', if(k % 3 = 2, 'more', 't1'), '","data":', to_json(named_struct('body', c)), '}')"""
    sentence = f"""concat(
        '{{"kind":"t1","data":', rtrim('}}', to_json(named_struct('author', lang, 'body', s, 'score', j))), ',"replies":',
        if(instr(s, ', ') > 0, concat('{{"data":{{"children":[',
            array_join(transform(split(s, ', '), (c, k) -> {clause}), ','), ']}}}}'), '""'), '}}}}')"""
    line = f"""concat(
        '{{"kind":"', if(i % 4 = 3, 'more', 't1'), '","data":', rtrim('}}', to_json(
            named_struct('author', source, 'body', l, 'score', if(i % 3 = 1, NULL, length(l))))), ',"replies":',
        if(instr(l, '. ') > 0, concat('{{"data":{{"children":[',
            array_join(transform(split(l, '[.] '), (s, j) -> {sentence}), ','), ']}}}}'), '""'), '}}}}')"""
    payload = f"""concat(
        '[{{"data":{{"children":[{{"data":', to_json(named_struct('title', title, 'selftext', text)), '}}]}}}},',
        '{{"data":{{"children":[', array_join(transform(split(text, '\\n'), (l, i) -> {line}), ','), ']}}}}]')"""
    return (
        table(spark, folder, "documents")
        .filter("doc_id % 10 <> 3")
        .withColumn("title", F.expr("split_part(text, '\\n', 1)"))
        .selectExpr(
            "doc_id",
            "concat('/r/', lang, '/comments/', doc_id, '/') AS permalink",
            f"CASE WHEN doc_id % 9 = 4 THEN '{{\"error\": 404}}' WHEN doc_id % 9 = 7 THEN concat('[', text) "
            f"ELSE {payload} END AS payload",
        )
    )


def detail_captures(spark: SparkSession, folder: str) -> DataFrame:
    """``(doc_id, permalink, payload, fetched_at)``: every capture, and for some a later broken or older one.

    Every fifth document has a later capture that is an error object, which must not hide the first;
    every seventh has an older one with a repeated JSON key.
    """
    first = details_raw(spark, folder).withColumn("fetched_at", F.lit(2))
    later = first.filter("doc_id % 5 = 0").withColumns({"payload": F.lit('{"error": 500}'), "fetched_at": F.lit(3)})
    twice = """[{"data":{"children":[{"data":{"title":"a","title":"b","selftext":"old"}}]}},{"data":{"children":[]}}]"""
    older = first.filter("doc_id % 7 = 0").withColumns({"payload": F.lit(twice), "fetched_at": F.lit(1)})
    return first.unionByName(later).unionByName(older)


def query_pages(spark: SparkSession, folder: str) -> DataFrame:
    """``(query, q_idx, page_no, payload)``: raw posts in listings by source and stretch of ids; a query's last page
    has no token, and one ends early."""
    fields = [
        "id", "name", "title", "author", "subreddit", "permalink", "url", "selftext", "created_utc", "score",
        "num_comments",
    ]
    placed = posts_raw(spark, folder).select(
        F.col("author").alias("query"),
        F.expr("doc_id div 200").alias("page_no"),
        "doc_id",
        F.to_json(F.struct(F.struct(*fields).alias("data"))).alias("child"),
    )
    pages = placed.groupBy("query", "page_no").agg(F.sort_array(F.collect_list(F.struct("doc_id", "child"))).alias("rows"))
    tokens = page_headers(spark, folder)
    after = F.coalesce(F.concat(F.lit('"'), F.col("after_token"), F.lit('"')), F.lit("null"))
    payload = F.concat(
        F.lit('{"data":{"after":'), after, F.lit(',"children":['),
        F.array_join(F.transform("rows", lambda r: r["child"]), ","), F.lit("]}}"),
    )
    q_idx = F.expr("CAST(substring(query, 4) AS INT)")
    return pages.join(tokens, ["query", "page_no"]).select("query", q_idx.alias("q_idx"), "page_no", payload.alias("payload"))


def query_page_captures(spark: SparkSession, folder: str) -> DataFrame:
    """As :func:`query_pages`, with ``fetched_at``: pages captured again, before and later, some of them broken.

    Every third page has an older capture without posts, every fourth a later one that is cut off, every
    fifth a copy, and every sixth a later error object.
    """
    first = query_pages(spark, folder).withColumn("fetched_at", F.lit(2))
    again = lambda every, rest, at, payload: first.filter(F.col("page_no") % every == rest).withColumns(
        {"payload": payload, "fetched_at": F.lit(at)}
    )
    empty = F.lit('{"data":{"after":"t3_0","children":[]}}')
    cut_off = F.expr("substring(payload, 1, 40)")
    parts = [
        first, again(3, 1, 1, empty), again(4, 2, 3, cut_off), again(5, 3, 2, F.col("payload")),
        again(6, 5, 4, F.lit('{"error": 503}')),
    ]
    return reduce(DataFrame.unionByName, parts)


def search_pages(spark: SparkSession, folder: str) -> DataFrame:
    """``(page_no, payload)``: raw posts in listings of ``PAGE_ROWS``, which bounds the groups."""
    fields = [
        "id", "name", "title", "author", "subreddit", "permalink", "url", "selftext", "created_utc", "score",
        "num_comments",
    ]
    placed = posts_raw(spark, folder).select(
        F.expr(f"doc_id div {PAGE_ROWS}").alias("page_no"),
        "doc_id",
        F.to_json(F.struct(F.struct(*fields).alias("data"))).alias("child"),
    )
    pages = placed.groupBy("page_no").agg(F.sort_array(F.collect_list(F.struct("doc_id", "child"))).alias("rows"))
    after = F.when(F.col("page_no") % 5 != 4, F.concat(F.lit('"t3_'), F.col("page_no"), F.lit('"')))
    payload = F.concat(
        F.lit('{"data":{"after":'),
        F.coalesce(after, F.lit("null")),
        F.lit(',"children":['),
        F.array_join(F.transform("rows", lambda r: r["child"]), ","),
        F.lit("]}}"),
    )
    return pages.select("page_no", payload.alias("payload"))


def page_headers(spark: SparkSession, folder: str) -> DataFrame:
    """``(query, page_no, after_token)``; a query's last page has no token, and one ends early."""
    pages = table(spark, folder, "documents").selectExpr("source AS query", "doc_id div 200 AS page_no").distinct()
    last = pages.groupBy("query").agg(F.max("page_no").alias("last"))
    return pages.join(last, "query").selectExpr(
        "query",
        "page_no",
        "CASE WHEN page_no = last OR (query = 'src5' AND page_no = 3) THEN NULL "
        "ELSE concat(query, '_', page_no) END AS after_token",
    )


def _posts_on_pages(spark: SparkSession, folder: str, distinct: int) -> DataFrame:
    return (
        table(spark, folder, "documents")
        .selectExpr("source AS query", "doc_id div 200 AS page_no", "doc_id AS pos", f"concat('p', n_chars % {distinct}) AS id")
        .filter("NOT (query = 'src7' AND page_no = 1) AND NOT (query = 'src8' AND page_no IN (1, 2))")
    )


def page_posts(spark: SparkSession, folder: str) -> DataFrame:
    """``(query, page_no, pos, id)`` with many repeats; some pages of two queries are empty."""
    return _posts_on_pages(spark, folder, 37)


def shared_page_posts(spark: SparkSession, folder: str) -> DataFrame:
    """As :func:`page_posts`, with more distinct posts, of which queries share many."""
    return _posts_on_pages(spark, folder, 211)


def seen_posts(spark: SparkSession, folder: str) -> DataFrame:
    """``(id)`` of posts that were collected before."""
    return table(spark, folder, "documents").filter("doc_id % 50 = 0").selectExpr("concat('p', n_chars % 211) AS id").distinct()


def request_log(spark: SparkSession, folder: str) -> DataFrame:
    """``(event_id, ts, endpoint, ok, status)``, one row per request outcome."""
    return table(spark, folder, "events").selectExpr(
        "event_id",
        "CAST(ts AS TIMESTAMP) AS ts",
        "concat('http://h', user_id, ':8080') AS endpoint",
        "event_type <> 'error' AS ok",
        "CASE WHEN event_type <> 'error' THEN 200 "
        "ELSE CASE CAST(get_json_object(props, '$.k') AS INT) WHEN 0 THEN 404 WHEN 1 THEN 429 "
        "ELSE 500 + CAST(get_json_object(props, '$.k') AS INT) END END AS status",
    )


def failure_log(spark: SparkSession, folder: str) -> DataFrame:
    """``(event_id, status)`` over all statuses from 400 to 599."""
    return table(spark, folder, "events").selectExpr(
        "event_id", "CAST(400 + 100 * (event_id % 2) + CAST(get_json_object(props, '$.k') AS INT) AS INT) AS status"
    )


def endpoint_lines(spark: SparkSession, folder: str) -> DataFrame:
    """``(pos, src_idx, line)``: endpoint list lines of three sources, blank and untidy ones included."""
    return table(spark, folder, "events").selectExpr(
        "event_id AS pos",
        "event_id % 3 AS src_idx",
        "CASE WHEN event_id % 17 = 0 THEN '   ' "
        "WHEN user_id % 4 = 0 THEN concat('http://h', user_id, ':8080') "
        "WHEN user_id % 4 = 1 THEN concat('  h', user_id, ':8080 ') "
        "WHEN user_id % 4 = 2 THEN concat('https://h', user_id, ':8080') "
        "ELSE concat('h', user_id, ':8080') END AS line",
    )
