"""A whole run on the smallest tables."""

import json
import re

from postlake.operators import enrichment
from postlake.plans import tables
from postlake.plans.run import harvest_run, search_run

FOLDER = "/root/testdata/sf0.001"


def test_run(spark, tmp_path):
    posts, details = tables.posts_raw(spark, FOLDER), tables.details_raw(spark, FOLDER).drop("doc_id")
    out = str(tmp_path / "out")
    for _ in range(2):  # a second run with the same id replaces the first
        search_run(posts, ["the", "dans", "zzz"], out, "r1", "2024-01-01 00:00:00", 20, details)
    written = spark.read.parquet(f"{out}/posts").filter("run_id = 'r1'")
    manifest = spark.read.parquet(f"{out}/runs").first()
    assert manifest["total_posts"] == written.count() > 20
    matching = {q: set() for q in ("the", "dans", "zzz")}
    for p in posts.collect():
        words = re.split("[^a-z0-9]+", (p["selftext"] or "").lower())
        for q in matching:
            if q in words and (p["id"] or p["permalink"]):
                matching[q].add(p["id"] or p["permalink"])
    want = [(q, min(20, len(keys))) for q, keys in matching.items()]
    assert [(q["query"], q["posts_collected"]) for q in manifest["queries"]] == want
    documents = [json.loads(r[0]) for r in spark.read.text(f"{out}/enriched/run_id=r1").collect()]
    found = [p for d in documents for p in d["posts"]]
    summary = documents[0]["enrichment_summary"]
    assert len(found) == summary["total"] == summary["success"] + summary["failed"] == written.count()
    assert documents[0]["metadata"]["total_posts"] == len(found)
    assert spark.read.parquet(f"{out}/failed").count() == summary["failed"] > 0
    comments = {}
    for r in enrichment.flatten_comments(details).filter("depth = 1").groupBy("permalink").count().collect():
        comments[r["permalink"]] = r["count"]
    for p in found:
        if "comments" in p:
            assert len(p["comments"]) == comments.get(p["permalink"], 0)


def page(ids, after="t"):
    children = [{"data": {"id": i, "name": i, "permalink": f"/r/{i}/"}} for i in ids]
    return json.dumps({"data": {"after": after, "children": children}})


def run_of(spark, folder, rows, limit, **more):
    pages = spark.createDataFrame(rows, "query string, q_idx int, page_no bigint, payload string, fetched_at int")
    harvest_run(pages, folder, "r1", "2024-01-01 00:00:00", limit, **more)
    posts = spark.read.parquet(f"{folder}/posts").orderBy("q_idx", "page_no", "pos").collect()
    return [(r["query"], r["page_no"], r["pos"], r["id"]) for r in posts], spark.read.parquet(f"{folder}/runs").first()


def test_pages_captured_again(spark, tmp_path):
    rows = [
        ("q", 1, 0, page(["a", "b"]), 1), ("q", 1, 0, page(["a", "b"]), 1), ("q", 1, 0, '{"data":', 9),
        ("q", 1, 1, page(["b", "x"]), 1), ("q", 1, 1, page(["b", "c"]), 2), ("q", 1, 1, '{"error": 1}', 3),
        ("q", 1, 2, "no page", 1), ("q", 1, 3, page(["late"]), 1),
        ("q", 4, 0, page(["a", "b"]), 0), ("p", 2, 0, page(["c", "d"], None), 1),
    ]
    posts, manifest = run_of(spark, str(tmp_path), rows, 100)
    assert posts == [("q", 0, 0, "a"), ("q", 0, 1, "b"), ("q", 1, 1, "c"), ("p", 0, 1, "d")]
    assert manifest["total_posts"] == 4
    stats = {r["query"]: (r["total"], r["unique_cnt"]) for r in spark.read.parquet(f"{tmp_path}/stats").collect()}
    assert stats == {"q": (3, 2), "p": (2, 1)}
    rejected = spark.read.parquet(f"{tmp_path}/rejected_pages").collect()
    assert sorted((r["page_no"], r["fetched_at"], r["reason"]) for r in rejected) == [(0, 9, "json"), (1, 3, "listing"), (2, 1, "json")]


def test_run_with_shared_and_earlier_posts(spark, tmp_path):
    pages = [["a", "b"], ["c", "d"], ["e", "f"], ["g"]]
    rows = [(q, i, n, page(ids, "t" if n < 3 else None), 1) for i, q in enumerate(["x", "y"]) for n, ids in enumerate(pages)]
    posts, _ = run_of(spark, str(tmp_path / "own"), rows, 2)
    assert [(q, i) for q, _, _, i in posts] == [("x", "a"), ("x", "b")]
    posts, _ = run_of(spark, str(tmp_path / "shared"), rows, 2, shared=True)
    assert [(q, i) for q, _, _, i in posts] == [("x", "a"), ("x", "b"), ("y", "c"), ("y", "d")]
    seen = spark.createDataFrame([("a",), ("e",)], "id string")
    posts, _ = run_of(spark, str(tmp_path / "seen"), rows, 2, seen=seen)
    assert [(q, i) for q, _, _, i in posts] == [("x", "b"), ("x", "c"), ("x", "d"), ("y", "f"), ("y", "g")]
