"""Comment trees against what their generator wrote down."""

import json
import random
import sys

import pytest
from pyspark.sql import functions as F

from postlake.operators import enrichment

sys.setrecursionlimit(20000)


def listing(nodes):
    return {"data": {"children": nodes}}


def payload(nodes, title="t", selftext="s"):
    return json.dumps([listing([{"data": {"title": title, "selftext": selftext}}]), listing(nodes)])


def comment(body, replies="", kind="t1", **more):
    return {"kind": kind, "data": {"author": "someone", "body": body, "score": 1, "replies": replies, **more}}


class Case:
    """A thread as JSON nodes together with the comments to expect, both written down while it is made.

    ``flat`` has ``(path, author, body, score)`` of every kept comment, ``tree`` the nested form.
    """

    def __init__(self):
        self.nodes, self.flat, self.tree = [], [], []


def case(nodes, flat, tree):
    made = Case()
    made.nodes, made.flat, made.tree = nodes, flat, tree
    return made


def leaf(body, *replies):
    return {"author": "someone", "body": body, "score": 1, "replies": list(replies)}


def chain(depth):
    made, node, tree = Case(), None, None
    for level in range(depth, 0, -1):
        body = f"level {level}"
        node = comment(body, listing([node]) if node else "")
        tree = leaf(body, *([tree] if tree else []))
        made.flat.append(([0] * level, "someone", body, 1))
    made.nodes, made.tree = [node], [tree]
    return made


def random_thread(rng):
    """Grown top down from open listings; what is under a stub is made, but not expected."""
    made = Case()
    open_listings = [(made.nodes, made.tree, (), True)]
    while open_listings:
        nodes, tree, path, kept_so_far = open_listings.pop()
        for place in range(rng.randint(0 if path else 1, 4)):
            kind = rng.choice(["t1", "t1", "t1", "more"])
            missing = rng.choice(["author", "score", "replies"]) if rng.random() < 0.2 else None
            body = f'say "{rng.random()}"\n'
            below, expected = [], []
            node = comment(body, listing(below) if len(path) < 8 and rng.random() < 0.6 else "", kind=kind)
            grows = node["data"]["replies"] != "" and missing != "replies"
            if missing:
                del node["data"][missing]
            nodes.append(node)
            kept = kept_so_far and kind == "t1"
            if kept:
                author, score = "" if missing == "author" else "someone", None if missing == "score" else 1
                made.flat.append(([*path, place], author, body, score))
                tree.append({"author": author, "body": body, "score": score, "replies": expected})
            if grows:
                open_listings.append((below, expected, (*path, place), kept))
    return made


def details(spark, named):
    rows = [(k, payload(v.nodes)) for k, v in named.items()]
    return spark.createDataFrame(rows, "permalink string, payload string")


ONE = lambda place, body: ([place], "someone", body, 1)
TREES = {
    "siblings": case(
        [comment("a", listing([comment("a1"), comment("a2")])), comment("b")],
        [ONE(0, "a"), ([0, 0], "someone", "a1", 1), ([0, 1], "someone", "a2", 1), ONE(1, "b")],
        [leaf("a", leaf("a1"), leaf("a2")), leaf("b")],
    ),
    "stub hides subtree": case(
        [comment("gone", listing([comment("gone too")]), kind="more"), comment("kept")], [ONE(1, "kept")], [leaf("kept")]
    ),
    "not an object": case(["text", 7, comment("kept")], [ONE(2, "kept")], [leaf("kept")]),
    "empty listing": case(
        [comment("a", listing([])), comment("b", {"data": {}}), comment("c", {})],
        [ONE(0, "a"), ONE(1, "b"), ONE(2, "c")],
        [leaf("a"), leaf("b"), leaf("c")],
    ),
    "no comments": case([], [], []),
    **{f"chain {n}": chain(n) for n in (1, 5, 6, 7, 8, 30, 199)},
    **{f"random {seed}": random_thread(random.Random(seed)) for seed in range(30)},
}


@pytest.fixture(scope="module")
def captured(spark):
    return details(spark, TREES).cache()


def test_flatten(captured):
    rows = {}
    for r in enrichment.flatten_comments(captured).collect():
        assert r["depth"] == len(r["path"])
        rows.setdefault(r["permalink"], []).append((r["path"], r["author"], r["body"], r["score"]))
    for name, tree in TREES.items():
        assert sorted(rows.get(name, [])) == sorted(tree.flat), name


def test_nest(captured):
    found = {r["permalink"]: r["comments_json"] for r in enrichment.nest_comments(captured).collect()}
    for name, tree in TREES.items():
        assert json.loads(found[name]) == tree.tree, name


def test_counts_and_depths(captured):
    for found in (enrichment.comment_stats(enrichment.flatten_comments(captured)), enrichment.thread_stats(captured)):
        stats = {r["permalink"]: r for r in found.collect()}
        assert stats["chain 199"]["n_comments"] == stats["chain 199"]["max_depth"] == 199
        assert "no comments" not in stats
    for with_comments in (True, False):
        ingested = enrichment.ingest_details(captured, with_comments).collect()
        assert {r["permalink"]: r["n_comments"] for r in ingested} == {k: len(v.flat) for k, v in TREES.items()}


def test_max_depth(captured):
    assert enrichment.flatten_comments(captured, max_depth=2).agg(F.max("depth")).first()[0] == 2


@pytest.mark.parametrize(
    "text",
    [
        "{broken",
        "",
        '{"error": 404}',
        "[]",
        '[{"data":{"children":[{"data":{"title":"t"}}]}}]',
        '[{"data":{"children":[{"data":{"title":"t"}}]}}, {}]',
        '[{"data":{"children":[]}}, {"data":{"children":[]}}]',
    ],
)
def test_unreadable_payloads_give_no_row(spark, text):
    captured = spark.createDataFrame([("p", text)], "permalink string, payload string")
    assert enrichment.ingest_details(captured).count() == 0
    assert enrichment.flatten_comments(captured).count() == 0


def test_rejected_captures(spark):
    deep = payload(chain(201).nodes)
    twice = '[{"data":{"children":[{"data":{"title":"a","title":"b"}}]}},{"data":{"children":[]}}]'
    rows = [("bad", "{broken"), ("none", None), ("error", '{"error": 404}'), ("deep", deep), ("good", payload([])), ("twice", twice)]
    captured = spark.createDataFrame(rows, "permalink string, payload string")
    found = {tuple(r) for r in enrichment.rejected_details(captured).collect()}
    assert found == {("bad", "json"), ("none", "json"), ("error", "listings"), ("deep", "json")}
    read = {r["permalink"]: r["title"] for r in enrichment.ingest_details(captured).collect()}
    assert read == {"good": "t", "twice": "b"}


def test_null_title_and_missing_body(spark):
    text = '[{"data":{"children":[{"data":{"title":null}}]}}, {"data":{"children":[]}}]'
    row = enrichment.ingest_details(
        spark.createDataFrame([("p", text)], "permalink string, payload string")
    ).first()
    assert (row["title"], row["body"], row["n_comments"]) == (None, "", 0)
