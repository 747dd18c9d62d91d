"""The replay against the page loop itself."""

import random

import pytest

from postlake.operators import harvest
from postlake.operators.search import query_list


def loop(pages, limit, tolerant):
    """Accepted page numbers of one query; ``pages`` maps a page number to (token, ids)."""
    seen, accepted, empties = set(), set(), 0
    for number in sorted(pages):
        if len(seen) >= limit:
            break
        token, ids = pages[number]
        accepted.add(number)
        seen |= {i for i in ids if i}
        empties = 0 if ids else empties + 1
        if not token or (not ids and (not tolerant or empties >= 2)):
            break
    return accepted


def captured(seed):
    rng = random.Random(seed)
    return {
        f"q{q}": {
            number: (
                rng.choice(["t"] * 12 + [None, ""]),
                [rng.choice([f"i{rng.randint(0, 60)}"] * 9 + ["", None]) for _ in range(rng.choice([0, 3, 5, 8]))],
            )
            for number in rng.sample(range(40), rng.randint(1, 25))
        }
        for q in range(25)
    }


@pytest.mark.parametrize("chunk", [1, 3, 1024])
@pytest.mark.parametrize("mode", ["strict", "tolerant"])
def test_same_as_loop(spark, monkeypatch, chunk, mode):
    monkeypatch.setattr(harvest, "_CHUNK_PAGES", chunk)
    runs = captured(chunk)
    headers = spark.createDataFrame(
        [(q, n, t) for q, pages in runs.items() for n, (t, _) in pages.items()],
        "query string, page_no bigint, after_token string",
    )
    posts = spark.createDataFrame(
        [(q, n, i) for q, pages in runs.items() for n, (_, ids) in pages.items() for i in ids],
        "query string, page_no bigint, id string",
    )
    for limit in (0, 1, 7, 20, 1000):
        rows = harvest.harvest_replay(headers, posts, limit, mode).collect()
        assert len(rows) == sum(map(len, runs.values()))
        got = {q: {r["page_no"] for r in rows if r["query"] == q and r["accepted"]} for q in runs}
        assert got == {q: loop(pages, limit, mode == "tolerant") for q, pages in runs.items()}


@pytest.mark.parametrize("mode", ["strict", "tolerant"])
def test_collected_posts(spark, mode):
    runs = captured(11)
    headers = spark.createDataFrame(
        [(q, n, t) for q, pages in runs.items() for n, (t, _) in pages.items()],
        "query string, page_no bigint, after_token string",
    )
    posts = spark.createDataFrame(
        [(q, n, p, i) for q, pages in runs.items() for n, (_, ids) in pages.items() for p, i in enumerate(ids)],
        "query string, page_no bigint, pos int, id string",
    )
    asked = query_list(spark, list(runs))
    want = set()
    for q, pages in runs.items():
        seen = set()
        for number in sorted(loop(pages, 20, mode == "tolerant")):
            for place, post in enumerate(pages[number][1]):
                if post and post not in seen:
                    seen.add(post)
                    want.add((q, post, number, place))
    rows = harvest.harvest_hits(headers, posts, asked, 20, mode).collect()
    assert len(rows) == len(want)
    assert {(r["query"], r["id"], r["page_no"], r["pos"]) for r in rows} == want


def test_unknown_mode(spark):
    with pytest.raises(ValueError):
        harvest.harvest_replay(None, None, 1, "other")


def shared_loop(runs, order, limit, tolerant, seen):
    """Queries one after another with one set of seen posts: accepted pages, new posts, collected posts."""
    seen, accepted, counts, collected = set(seen), set(), {}, []
    for q in order:
        new, empties, stopped = 0, 0, False
        here = set(seen)
        for number in sorted(runs[q]):
            token, ids = runs[q][number]
            fresh = list(dict.fromkeys(i for i in ids if i and i not in here))
            here |= set(fresh)
            counts[q, number] = len(fresh)
            if stopped or new >= limit:
                continue
            accepted.add((q, number))
            collected += [(q, i, number, ids.index(i)) for i in fresh]
            seen |= set(fresh)
            new += len(fresh)
            empties = 0 if ids else empties + 1
            stopped = not token or (not ids and (not tolerant or empties >= 2))
    return accepted, counts, collected


@pytest.mark.parametrize(("seed", "limit", "mode"), [(1, 12, "strict"), (2, 30, "tolerant"), (3, 0, "strict"), (4, 1000, "tolerant")])
def test_queries_that_share_what_they_saw(spark, seed, limit, mode):
    runs = captured(seed)
    headers = spark.createDataFrame(
        [(q, n, t) for q, pages in runs.items() for n, (t, _) in pages.items()],
        "query string, page_no bigint, after_token string",
    )
    posts = spark.createDataFrame(
        [(q, n, p, i) for q, pages in runs.items() for n, (_, ids) in pages.items() for p, i in enumerate(ids)],
        "query string, page_no bigint, pos int, id string",
    )
    order = sorted(runs, reverse=True)
    asked = spark.createDataFrame([(i, q) for i, q in enumerate(order)] + [(99, order[0])], "q_idx int, query string")
    for known in ([], [f"i{n}" for n in range(0, 60, 7)]):
        table = spark.createDataFrame([(k,) for k in known], "id string") if known else None
        accepted, counts, collected = shared_loop(runs, order, limit, mode == "tolerant", known)
        rows = harvest.harvest_shared(headers, posts, asked, limit, mode, table).collect()
        assert {(r["query"], r["page_no"]) for r in rows if r["accepted"]} == accepted
        assert {(r["query"], r["page_no"]): r["new_cnt"] for r in rows} == counts
        hits = harvest.harvest_shared_hits(headers, posts, asked, limit, mode, table).collect()
        assert sorted((r["query"], r["id"], r["page_no"], r["pos"]) for r in hits) == sorted(collected)


def test_shared_harvest_of_nothing(spark):
    headers = spark.createDataFrame([], "query string, page_no bigint, after_token string")
    posts = spark.createDataFrame([], "query string, page_no bigint, pos int, id string")
    assert harvest.harvest_shared(headers, posts, query_list(spark, ["a"]), 5).collect() == []
