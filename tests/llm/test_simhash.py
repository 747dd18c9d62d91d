"""SimHash against plain loops."""

import re

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from postlake.llm.components import connected_components
from postlake.llm.queries import QUERIES
from postlake.llm.simhash import (
    close_pairs, exact_masks, hexadecimal, near_duplicates, shingle_hashes, without_near_duplicates,
)

FOLDER = "/root/testdata/sf0.001"


def loop_fingerprint(text, words=3):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    found = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not found:
        return 0
    runs = [" ".join(found[i : i + words]) for i in range(len(found) - words + 1)] or [" ".join(found)]
    hashes = [xxhash.xxh64(r.encode(), seed=42).intdigest() for r in runs]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def loop_components(ids, prints, radius=3):
    group = list(range(len(ids)))
    for i in range(len(ids)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= radius and group[i] != group[j]:
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    least = {}
    for i, g in zip(ids, group, strict=True):
        least[g] = min(least.get(g, i), i)
    return [least[g] for g in group]


def test_registered_query(spark):
    rows = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    prints = [loop_fingerprint(r.text) for r in rows]
    want = {
        (r.doc_id, f"{p:016x}", c)
        for r, p, c in zip(rows, prints, loop_components([r.doc_id for r in rows], prints), strict=True)
    }
    assert {tuple(r) for r in QUERIES["op2_simhash"](spark, FOLDER).collect()} == want


def test_awkward_rows(spark):
    long = "word " * 70_000
    rows = [
        (1, None, "x"), (2, "", "x"), (3, " \t\n\x0b", "x"), (4, "One", "x"), (5, "one", "x"), (6, "one two", "x"),
        (7, long, "x"), (8, long + "end", "x"), (None, "one", "x"), (9, "a b É é", "x"), (9, "a b É é", "x"),
        (10, "a b é é", "x"), (None, "only here", "x"),
    ]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, fingerprint string")
    got = near_duplicates(docs).select("doc_id", hexadecimal("fingerprint").alias("f"), "component_id").collect()
    assert len(got) == len(rows)
    prints = [loop_fingerprint(t) for _, t, _ in rows]
    named = [i if i is not None else 99 for i, _, _ in rows]
    want = loop_components(named, prints)
    expected = sorted((str(i), f"{p:016x}", c if c != 99 else None) for (i, _, _), p, c in zip(rows, prints, want, strict=True))
    assert sorted((str(r.doc_id), r.f, r.component_id) for r in got) == expected
    assert near_duplicates(docs.limit(0)).collect() == []


def test_hot_groups_of_copies_and_near_copies(spark, monkeypatch):
    monkeypatch.setattr("postlake.llm.simhash._BUCKET_ROWS", 16)
    words = [f"w{i}" for i in range(400)]
    near = [" ".join(words[:k] + ["changed"] + words[k + 1 :]) for k in range(0, 400, 4)]
    rows = [(i, "the very same text again and again") for i in range(300)] + [(300 + i, t) for i, t in enumerate(near)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.doc_id: r.component_id for r in near_duplicates(docs).collect()}
    prints = [loop_fingerprint(t) for _, t in rows]
    assert got == dict(zip([i for i, _ in rows], loop_components([i for i, _ in rows], prints), strict=True))


@pytest.mark.parametrize(("width", "radius"), [(1, 0), (1, 3), (1, 5), (2, 9), (4, 46)])
def test_bit_sliced_pairs(width, radius):
    draw = np.random.default_rng(radius)
    codes = draw.integers(0, 1 << 63, (300, width), np.int64).view(np.uint64)
    for i in range(1, 300, 2):  # neighbours at all distances around the radius
        flips = draw.choice(64 * width, min(64 * width, radius + i % 5 - 2 if radius > 2 else i % 3), replace=False)
        codes[i] = codes[i - 1]
        for f in flips:
            codes[i, f // 64] ^= np.uint64(1) << np.uint64(f % 64)
    sizes = [1, 2, 130, 67, 100]
    ends = np.repeat(np.cumsum(sizes), sizes)
    found = set()
    close_pairs(np.ascontiguousarray(codes), ends, radius, lambda i, j: found.update(zip(i.tolist(), j.tolist(), strict=True)))
    whole = [int.from_bytes(c.tobytes(), "little") for c in codes]
    want = {
        (i, j) for i in range(300) for j in range(i + 1, int(ends[i])) if (whole[i] ^ whole[j]).bit_count() <= radius
    }
    assert found == want and want


@pytest.mark.parametrize("rows", [1, 10**5, 10**8, 10**11])
def test_exact_masks_miss_nothing(rows):
    masks = exact_masks(rows, 64, 3)
    draw = np.random.default_rng(1)
    for _ in range(500):
        difference = sum(1 << int(b) for b in draw.choice(64, 3, replace=False))
        assert any(difference & m == 0 for m in masks)
    assert min(m.bit_count() for m in masks) >= min(16, np.log2(rows) - 8)


def test_components(spark):
    chain = [(i, i + 1) for i in range(200)]
    star = [(1000, 1000 + i) for i in range(1, 300)] + [(1299, 5000), (5000, 4999), (7, 7)]
    edges = spark.createDataFrame([*chain, *star, (3, None)], "a bigint, b bigint")
    got = {r.node: r.component for r in connected_components(edges).collect()}
    assert got == {i: 0 for i in range(201)} | {i: 1000 for i in [*range(1000, 1300), 4999, 5000]}
    assert connected_components(edges.limit(0)).collect() == []


def test_shingles_of_words():
    assert len(shingle_hashes(b"", 3)) == 0
    assert shingle_hashes(b"A  b", 3).tolist() == [xxhash.xxh64_intdigest(b"a b", 42)]
    assert isinstance(pa.array(shingle_hashes(b"a b c d", 3)), pa.UInt64Array)


def test_one_row_of_each_group_stays(spark):
    """Repeated ids with other texts, repeated rows, rows without id; clashing names."""
    base = " ".join(f"w{i}" for i in range(300))
    rows = [
        (1, "A text", 1), (9, "A text", 2), (9, "B and something else", 3), (4, "twice the same", 4), (4, "twice the same", 5),
        (None, "a TEXT", 6), (None, "only here", 7), (None, "only here", 8), (None, "here too", 9), (2, "here  too", 10),
        (20, None, 11), (21, "", 12), (None, " ", 13), (30, base, 14), (31, base + " w300", 15), (29, base.upper(), 16),
    ]
    docs = spark.createDataFrame([(*r, "x", "y") for r in rows], "doc_id bigint, text string, component_id int, _key string, `row` string")
    got = without_near_duplicates(docs)
    assert got.columns == docs.columns
    kept = [(r.doc_id, r.text, r.component_id) for r in got.collect()]
    prints = [loop_fingerprint(t) for _, t, _ in rows]
    group = loop_components(list(range(len(rows))), prints)
    best = lambda g: min(((r[0] is None, r[0] or 0) for r, of in zip(rows, group, strict=True) if of == g))
    assert len(kept) == len(set(group))
    assert sorted(group[n - 1] for _, _, n in kept) == sorted(set(group))
    assert all((i is None, i or 0) == best(group[n - 1]) for i, _, n in kept)
    assert without_near_duplicates(docs.limit(0)).collect() == []


def test_groups_of_the_tables(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = docs.select("doc_id", "text").collect()
    want = set(loop_components([r.doc_id for r in rows], [loop_fingerprint(r.text) for r in rows]))
    assert sorted(r.doc_id for r in without_near_duplicates(docs).collect()) == sorted(want)


def test_texts_are_shuffled_once(spark, capsys):
    """The rows that stay are found with one shuffle of the texts, whichever size Spark expects of those that go."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    for threshold in ("-1", before):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        try:
            found = without_near_duplicates(docs)
            capsys.readouterr()
            found.explain("formatted")
        finally:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        shuffled = re.findall(r"Exchange *\nInput \[\d+\]: \[(.*)\]", capsys.readouterr().out)
        assert sum("row#" in columns for columns in shuffled) == 1
