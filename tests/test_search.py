"""Search, paging and run statistics against plain loops."""

import random
import re

import pytest

from postlake.operators import search
from postlake.operators.ranking import dedupe_first_seen, top_per_group

VOCABULARY = ["red", "blue", "green", "tea", "é", "naïve", "x1"]
QUERIES = ["red", "Blue tea", "green", "nothing"]


def corpus(seed, n=120):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        text = " ".join(rng.choice(VOCABULARY) for _ in range(rng.randint(0, 12)))
        rows.append((i, rng.choice([f"p{i % 40}", f"p{i}", "", None]), text.upper() if i % 5 == 0 else text))
    return rows


def tokens(text):
    return [w for w in re.split(r"[\W_]+", text.lower()) if w]


def expected_hits(rows, queries, limit):
    hits = {}
    for q in queries:
        wanted = set(tokens(q))
        scored = [(sum(w in wanted for w in tokens(t)), i, p) for i, p, t in rows if p]
        best, seen = [], set()
        for tf, i, p in sorted((s for s in scored if s[0]), key=lambda s: (-s[0], s[1])):
            if p not in seen:
                seen.add(p)
                best.append((p, tf, i))
        hits[q] = best[:limit]
    return hits


@pytest.mark.parametrize("limit", [1, 10, 5000])
def test_keyword_search(spark, limit):
    rows = corpus(limit)
    posts = spark.createDataFrame(rows, "doc_id bigint, id string, text string")
    got = {}
    for r in search.keyword_search(posts, QUERIES, limit).orderBy("q_idx", "pos").collect():
        assert r["pos"] == len(got.setdefault(r["query"], [])) + 1
        got[r["query"]].append((r["id"], r["tf"], r["doc_id"]))
    assert got == {q: h for q, h in expected_hits(rows, QUERIES, limit).items() if h}


def test_query_table_and_filter(spark):
    rows = corpus(3)
    posts = spark.createDataFrame(rows, "doc_id bigint, id string, text string")
    asked = search.query_list(spark, ["red", "green", "red"])
    assert [tuple(r) for r in asked.orderBy("q_idx").collect()] == [(1, "red"), (2, "green")]
    hits = search.keyword_search(posts, asked, 10, extra_filters=posts["doc_id"] >= 60)
    want = expected_hits(rows[60:], ["red", "green"], 10)
    assert hits.count() == sum(map(len, want.values()))


@pytest.fixture(scope="module")
def hits(spark):
    rows = corpus(7)
    posts = spark.createDataFrame(rows, "doc_id bigint, id string, text string")
    return search.keyword_search(posts, QUERIES, 10).cache(), expected_hits(rows, QUERIES, 10)


def test_statistics(hits):
    found, want = hits
    ids = {q: {h[0] for h in hs} for q, hs in want.items()}
    stats = {r["query"]: (r["total"], r["unique_cnt"]) for r in search.query_stats(found, QUERIES).collect()}
    others = {q: set().union(*(ids[o] for o in ids if o != q)) for q in ids}
    assert stats == {q: (len(ids[q]), len(ids[q] - others[q])) for q in QUERIES}
    seen, new = set(), {}
    for q in QUERIES:
        new[q] = len(ids[q] - seen)
        seen |= ids[q]
    assert {r["query"]: r["new_cnt"] for r in search.search_new_in_order(found, QUERIES).collect()} == new
    owned = search.search_multi(found)
    assert owned.count() == len(seen) == sum(new.values())
    manifest = search.run_manifest(found, "2024-01-02 03:04:05", QUERIES).first()
    assert manifest["timestamp"] == "2024-01-02 03:04:05" and manifest["total_posts"] == len(seen)
    assert [(e["query"], e["posts_collected"], e["unique_posts"]) for e in manifest["queries"]] == [
        (q, *stats[q]) for q in QUERIES
    ]


def test_pages(spark, hits):
    found, want = hits
    expected = [h[0] for h in want["red"]]
    rows = search.search_page(found.filter("query = 'red'"), 4).orderBy("pos").collect()
    assert [r["page_no"] for r in rows] == [i // 4 for i in range(len(expected))]
    assert rows[0]["next_token"] == expected[3] and rows[-1]["next_token"] is None
    others = {q: [h[0] for h in want[q]] for q in want if q != "red"}
    tokens = {"red": expected[3], "green": "no such id", "nothing": None}
    for after in (tokens, spark.createDataFrame(list(tokens.items()), "query string, after string")):
        rest = search.search_page(found, 4, after).orderBy("q_idx", "pos").collect()
        assert [r["id"] for r in rest if r["query"] == "red"] == expected[4:]
        assert next(r for r in rest if r["query"] == "red")["page_no"] == 0
        for q, ids in others.items():  # without a known token a query starts at its first page
            assert [r["id"] for r in rest if r["query"] == q] == ids
    assert {r["page_no"] for r in search.search_page(found, 0).filter("query = 'red'").collect()} == set(range(len(expected)))


def test_words_of_other_scripts(spark):
    rows = [(1, "a", "Привет, мир"), (2, "b", "f r"), (3, "c", "für dich"), (4, "d", "東京 2024")]
    posts = spark.createDataFrame(rows, "doc_id bigint, id string, text string")
    found = search.keyword_search(posts, ["привет", "für", "東京"], 10).collect()
    assert {(r["query"], r["id"]) for r in found} == {("привет", "a"), ("für", "c"), ("東京", "d")}
    with pytest.raises(ValueError):
        search.keyword_search(posts, ["tea", "?!"], 10)


def test_salted_cut_is_exact(spark):
    rng = random.Random(1)
    rows = [("hot" if i % 3 else f"g{i % 7}", rng.random(), i) for i in range(6000)]
    df = spark.createDataFrame(rows, "g string, v double, n int")
    top = top_per_group(df, ["g"], ["v", "n"], 1500)
    hot = sorted((v, n) for g, v, n in rows if g == "hot")[:1500]
    got = top.filter("g = 'hot'").orderBy("pos").collect()
    assert [(r["v"], r["n"]) for r in got] == hot and [r["pos"] for r in got] == list(range(1, 1501))
    assert top.filter("g <> 'hot'").count() == 2000


def test_first_seen_is_idempotent(spark):
    df = spark.createDataFrame([("b", 3), ("a", 2), ("b", 1), ("", 0), (None, 5)], "k string, pos int")
    once = dedupe_first_seen(df, "k", ["pos"])
    assert sorted(map(tuple, once.collect())) == [("a", 2), ("b", 1)]
    assert sorted(map(tuple, dedupe_first_seen(once, "k", ["pos"]).collect())) == [("a", 2), ("b", 1)]


def test_marks_belong_to_words(spark):
    """Vowel signs and accents that are characters of their own do not cut a word."""
    hindi, accented = "\u0939\u093f\u0928\u094d\u0926\u0940", "cafe\u0301s"
    rows = [(1, "a", f"x {hindi}, y"), (2, "b", f"{accented}!"), (3, "c", "cafe s \u0939 \u0928")]
    posts = spark.createDataFrame(rows, "doc_id bigint, id string, text string")
    hits = search.keyword_search(posts, [hindi, accented, "cafe"], 10).collect()
    assert sorted((r["query"], r["id"], r["tf"]) for r in hits) == sorted([(hindi, "a", 1), (accented, "b", 1), ("cafe", "c", 1)])
