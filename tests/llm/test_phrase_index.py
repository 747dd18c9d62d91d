"""The positional index against loops over the words."""

import hashlib
import random
import re

import numpy as np
import pytest

from postlake.llm import phrase_index
from postlake.llm.phrase_index import build_index, contamination, find_phrases, indexed_documents, phrases_of
from postlake.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


def words(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def loop(docs, items, slack, width=10):
    """``[(doc_id, n_words, n_hit, n_items, sha, contaminated, n_near)]`` in the order of ``docs``."""
    phrases = {}
    for item, text in items:
        w = words(text)
        for i in range(max(len(w) - width, 0) + 1 if w else 0):
            phrases.setdefault(tuple(w[i : i + width]), set()).add("null" if item is None else str(item))
    texts = [words(t) for _, t in docs]
    totals = {}
    for w in texts:
        for x in w:
            totals[x] = totals.get(x, 0) + 1
    found = []
    for (doc_id, _), w in zip(docs, texts, strict=True):
        at = {}
        for i, x in enumerate(w):
            at.setdefault(x, set()).add(i)
        hit, names, near = set(), set(), set()
        for p, own in phrases.items():
            if any(x not in at for x in p):
                continue
            anchor = min(range(len(p)), key=lambda i: (totals[p[i]], p[i].encode(), i))
            for pos in at[p[anchor]]:
                start = pos - anchor
                if all(any(start + i + d in at[x] for d in range(-slack, slack + 1)) for i, x in enumerate(p)):
                    near |= own
                if all(start + i in at[x] for i, x in enumerate(p)):
                    hit |= set(range(start, start + len(p)))
                    names |= own
        digest = hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
        found.append((doc_id, len(w), len(hit), len(names), digest, bool(hit), len(near - names)))
    return found


def rows_of(frame):
    names = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "n_near")
    return sorted((tuple(r[n] for n in names) for r in frame.collect()), key=repr)


def test_registered_query(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").select("item_id", "text").collect()]
    want = loop(docs, items, phrase_index.SLACK)
    assert rows_of(QUERIES["op13_contamination"](spark, FOLDER)) == sorted(want, key=repr)
    assert any(w[5] for w in want)


@pytest.mark.parametrize(("seed", "slack", "segment", "parts"), [(1, 0, 40, 7), (2, 2, 300, 1 << 17), (3, 1, 10**6, 50)])
def test_against_loops(spark, monkeypatch, seed, slack, segment, parts):
    """Few distinct words, so that phrases overlap, repeat and nearly occur; small segments and blocks of phrases."""
    monkeypatch.setattr(phrase_index, "_PHRASES_AT_ONCE", parts)
    draw = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(30)] + ["É", "é", "x1", "ñu"]
    text = lambda n: draw.choice([" ", ", ", "\n"]).join(draw.choice(vocabulary) for _ in range(n))
    items = [(i, text(draw.choice([0, 1, 3, 9, 10, 11, 25]))) for i in range(25)]
    items += [(7, text(14)), (None, "W1 w2"), (None, None), (30, ""), (31, "..."), (32, items[3][1])]
    docs = []
    for i in range(60):
        held = [text(draw.randint(0, 20))]
        for _ in range(draw.randint(0, 3)):
            w = words(draw.choice(items)[1])
            if w and draw.random() < 0.5:
                w.insert(draw.randrange(len(w)), "extra")
            held += [" ".join(w).upper() if draw.random() < 0.3 else " ".join(w), text(draw.randint(0, 5))]
        docs.append((i, " ; ".join(held)))
    docs += [(None, docs[5][1]), (5, docs[6][1]), (5, docs[6][1]), (61, None), (62, ""), (63, " !"), (64, text(5000))]
    frame = spark.createDataFrame([(*d, 0, "t") for d in docs], "doc_id bigint, text string, n int, term string").repartition(3)
    index = build_index(frame, segment)
    asked = phrases_of(spark.createDataFrame([(*i, 0) for i in items], "item_id bigint, text string, phrase int"))
    want = loop(docs, items, slack)
    assert rows_of(contamination(index, asked, slack)) == sorted(want, key=repr)
    assert sum(w[2] for w in want) > 50


def test_hot_passage(spark):
    """A passage that a third of the texts hold, and texts of one word."""
    passage = "the quick brown fox jumps over the lazy dog and then sleeps"
    docs = [(i, f"n{i} {passage} m{i}" if i % 3 == 0 else "the " * 40) for i in range(900)]
    items = [(1, passage), (2, "the the the the the the the the the the the")]
    index = build_index(spark.createDataFrame(docs, "doc_id bigint, text string").repartition(5))
    got = rows_of(contamination(index, phrases_of(spark.createDataFrame(items, "item_id bigint, text string"))))
    assert got == sorted(loop(docs, items, 2), key=repr)


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "some words here")], "doc_id bigint, text string")
    items = spark.createDataFrame([(1, "some words")], "item_id bigint, text string")
    assert contamination(build_index(docs.limit(0)), phrases_of(items)).collect() == []
    nothing = contamination(build_index(docs), phrases_of(items.limit(0))).collect()
    assert [tuple(r)[:4] for r in nothing] == [(1, 3, 0, 0)]
    with pytest.raises(ValueError):
        find_phrases(build_index(docs), phrases_of(items), 40)
    assert [tuple(r)[2:] for r in indexed_documents(build_index(docs)).collect()] == [(1, 3)]


def test_blocks_of_places(monkeypatch):
    """Candidates in small blocks give what they give at once."""
    draw = np.random.default_rng(4)
    each = [np.sort(draw.choice(np.arange(64, 4000), size, replace=False)) for size in (5, 400, 1500, 3000)]
    held = phrase_index._Lists(np.array([10, 20, 30, 40]), each, 4000)
    ids = draw.choice([10, 20, 30, 40, 50], (300, 4), p=[0.1, 0.2, 0.3, 0.38, 0.02])
    rows, sizes = held.rows_of(ids), draw.integers(1, 5, 300)
    offsets = np.stack([draw.permutation(4) for _ in range(300)])
    whole = [np.concatenate(x) for x in zip(*phrase_index._places(held, rows, offsets, sizes, 1), strict=True)]
    monkeypatch.setattr(phrase_index, "_PLACES_AT_ONCE", 10)
    pieces = [np.concatenate(x) for x in zip(*phrase_index._places(held, rows, offsets, sizes, 1), strict=True)]
    assert all(np.array_equal(a, b) for a, b in zip(whole, pieces, strict=True)) and len(whole[0])
