"""Merkle trees against plain loops over hashlib."""

import hashlib
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from postlake.llm import sha_states
from postlake.llm.manifest import build_manifest, digest_of, fold
from postlake.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


def sha(*texts):
    return hashlib.sha256("".join(texts).encode()).hexdigest()


def told(*values):
    return sha(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def levels_of(leaves, arity):
    levels = [leaves]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([sha(*below[i : i + arity]) for i in range(0, len(below), arity)])
    return levels


def climb(levels, at, value, arity):
    """The root with ``value`` at leaf ``at``, and the siblings on the way."""
    siblings = []
    for level in levels[:-1]:
        first = at // arity * arity
        run = level[first : first + arity]
        siblings += run[: at - first] + run[at - first + 1 :]
        run[at - first] = value
        value, at = sha(*run), at // arity
    return value, siblings


def loop(trees, replaced, arity=2):
    """``{(tree, place): (leaf, subroot, root, proof, folded)}`` of lists of leaves by name of tree."""
    names = sorted(trees, key=lambda t: t.encode())
    inside = {t: levels_of(trees[t], arity) for t in names}
    top = levels_of([inside[t][-1][0] for t in names], arity) if names else []
    found = {}
    for i, t in enumerate(names):
        for at, leaf in enumerate(trees[t]):
            value, siblings = climb(inside[t], at, replaced.get((t, at), leaf), arity)
            folded, more = climb(top, i, value, arity)
            found[t, at] = leaf, inside[t][-1][0], top[-1][0], sha(*siblings, *more), folded
    return found


def test_states():
    draw = np.random.default_rng(1)
    parts = [draw.bytes(32) for _ in range(50)]
    digests = sha_states.from_bytes(b"".join(parts))
    assert sha_states.to_bytes(digests) == b"".join(parts)
    state = np.repeat(sha_states.START, 50, axis=1)
    for blocks in range(3):
        ended = sha_states.to_bytes(sha_states.finished(state, np.full(50, blocks)))
        assert ended == b"".join(hashlib.sha256(p.hex().encode() * blocks).digest() for p in parts)
        state = sha_states.resumed(state, sha_states.hex_blocks(digests))


def test_registered_query(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").orderBy("doc_id").collect()
    trees, replaced, places = {}, {}, {}
    for d in docs:
        held = trees.setdefault("" if d.lang is None else "=" + d.lang, [])
        key = ("" if d.lang is None else "=" + d.lang, len(held))
        places[d.doc_id] = key
        held.append(told(d.doc_id, d.source, d.lang, d.n_chars, d.text))
        if zlib.crc32(str(d.doc_id).encode()) % 7 == 0 and d.n_chars is not None:
            replaced[key] = told(d.doc_id, d.source, d.lang, d.n_chars + 1, d.text)
    want = loop(trees, replaced)
    got = {r.doc_id: r for r in QUERIES["op11_manifest"](spark, FOLDER).collect()}
    assert got.keys() == places.keys()
    for doc_id, key in places.items():
        r = got[doc_id]
        assert (r.leaf, r.subroot, r.root, r.proof_sha256, r.folded_root) == want[key]
        assert r.verified == (key not in replaced)


@pytest.mark.parametrize(("arity", "levels"), [(2, 1), (2, 2), (3, 2), (2, 12), (5, 1)])
def test_many_rounds(spark, arity, levels):
    """Blocks far smaller than the trees, a tree with most of the leaves, many small trees."""
    sizes = {"": 1, "=big": 150, "=é": 2, **{f"={i}": i % 4 + 1 for i in range(20)}}
    trees = {t: [sha(t, str(i)) for i in range(n)] for t, n in sizes.items()}
    replaced = {(t, i): sha("new", t, str(i)) for t, n in sizes.items() for i in range(0, n, 3)}
    rows = [
        (t, i, bytes.fromhex(x), bytes.fromhex(replaced[t, i]) if (t, i) in replaced else None, "kept")
        for t, held in trees.items() for i, x in enumerate(held)
    ]
    frame = spark.createDataFrame(rows, "tree string, at int, digest binary, other binary, root_note string").repartition(7)
    got = fold(build_manifest(frame, ["at"], arity, levels), "other").collect()
    want = loop(trees, replaced, arity)
    assert len(got) == len(rows) and {r.root_note for r in got} == {"kept"}
    found = {(r.digest.hex(), r.at): (r.digest.hex(), r.subroot, r.root, r.proof_sha256, r.folded_root) for r in got}
    assert found == {(w[0], key[1]): w for key, w in want.items()}


def test_odd_rows(spark, tmp_path):
    """Nulls, repeated rows and ids, a long text, further columns; and no rows at all."""
    long = "word " * 300_000
    rows = [
        (None, None, None, None, None, 1), (None, None, None, None, None, 1), (4, "a", None, "s", None, 1), (4, "a", None, "s", None, 2),
        (4, "b", "en", "s", 2**63 - 1, 1), (0, "", "", "", 0, 1), (21, long, "en", "s", len(long), 1), (7, "ß", "en", "s", 1, 1),
    ]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, digest int"
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "documents.parquet"))
    got = QUERIES["op11_manifest"](spark, str(tmp_path)).collect()
    assert len(got) == len(rows) and len({r.root for r in got}) == 1
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, told(r[0], r[3], r[2], r[4], r[1])))
    trees, want_bad = {}, set()
    for doc_id, text, lang, source, n, _ in order:
        trees.setdefault("" if lang is None else "=" + lang, []).append(told(doc_id, source, lang, n, text))
        if doc_id is not None and n is not None and zlib.crc32(str(doc_id).encode()) % 7 == 0:
            want_bad.add(doc_id)
    want = loop(trees, {})
    assert sorted(r.proof_sha256 for r in got) == sorted(w[3] for w in want.values())
    assert {r.root for r in got} == {next(iter(want.values()))[2]}
    assert {r.doc_id for r in got if not r.verified} == want_bad
    spark.createDataFrame([], schema).write.parquet(str(tmp_path / "none" / "documents.parquet"))
    assert QUERIES["op11_manifest"](spark, str(tmp_path / "none")).collect() == []


def test_digest_of(spark):
    frame = spark.createDataFrame([(None, "é", -3), (1, None, None)], "a int, b string, c bigint")
    assert [r[0] for r in frame.select(digest_of([F.col("a"), F.col("b"), F.col("c")])).collect()] == [
        told(None, "é", -3), told(1, None, None)
    ]
