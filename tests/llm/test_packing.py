"""Tokens, token files, sharding and packing against the tokenizers library and plain loops."""

import zlib
from collections import defaultdict

import numpy as np
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from postlake.llm.packing import Capacity, best_fit, pack, sequences
from postlake.llm.queries import QUERIES, WORD_TOKENIZER
from postlake.llm.sharding import _bucket, fisher_yates, sharded
from postlake.llm.token_files import read_tokens, write_tokens
from postlake.llm.tokens import WordEncoder, vocabulary
from postlake.session import shared_folder

FOLDER = "/root/testdata/sf0.001"
PATH = vocabulary(WORD_TOKENIZER)
LIBRARY = Tokenizer.from_file(PATH)
AWKWARD = [
    (3, "b", 1), (1, None, 1), (2, "", 1), (None, "no id", 1), (5, "word " * 9000, 1), (4, "x" * 3000, 1),
    (6, "It's <|endoftext|> ＡＢ é z　\x85 👩‍👩‍👧", 1), (3, "b", 1), (3, "a", 1),
]


def ids_of(text):
    return [*LIBRARY.encode(text or "", add_special_tokens=False).ids, 1]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(st.characters(exclude_categories=["Cs"])), max_size=4))
def test_words_add_up_to_texts(texts):
    ids, sizes = WORDS.encode([t.encode() for t in texts], 1)
    assert ids.tolist() == [i for t in texts for i in ids_of(t)]
    assert sizes.tolist() == [len(ids_of(t)) for t in texts]


WORDS = WordEncoder(PATH)


def test_forgetting_changes_nothing(monkeypatch):
    monkeypatch.setattr("postlake.llm.tokens._WORDS_KEPT", 40)
    small = WordEncoder(PATH)
    draw = np.random.default_rng(1)
    for _ in range(60):
        texts = [" ".join(f"Wörd{x}, and" for x in draw.zipf(1.5, 20)) for _ in range(3)]
        ids, _ = small.encode([t.encode() for t in texts], 1)
        assert ids.tolist() == [i for t in texts for i in ids_of(t)]


def documents(spark, folder=FOLDER):
    return spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()


def test_token_file_query(spark):
    want, start = [], 0
    for r in documents(spark):
        ids = ids_of(r.text)
        want.append((r.doc_id, start, len(ids), crc(ids)))
        start += len(ids)
    assert sorted(tuple(r) for r in QUERIES["op4_token_files"](spark, FOLDER).collect()) == want


@pytest.mark.parametrize("encoding", ["dictionary", "delta"])
def test_token_files(spark, encoding):
    rows = AWKWARD + [(100 + i, f"text {i} " * 50, 1) for i in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, ids int")
    path = shared_folder(spark, "tokens")
    write_tokens(docs, path, PATH, encoding=encoding, row_group_bytes=1 << 16, page_rows=100)
    kept = sorted((r for r in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    want, start = [], 0
    for i, t, _ in kept:
        want.append((i, start, ids_of(t)))
        start += len(ids_of(t))
    got = read_tokens(spark, path).orderBy("start").collect()
    assert [(r.doc_id, r.start, list(r.ids)) for r in got] == want
    files = [f.removeprefix("file:") for f in spark.read.parquet(path).inputFiles()]
    groups = [pq.ParquetFile(f).metadata for f in files]
    assert sum(m.num_row_groups for m in groups) > len(files)
    ids = [m.row_group(g).column(m.num_columns - 1) for m in groups for g in range(m.num_row_groups)]
    assert all(c.has_offset_index and c.has_column_index for c in ids)
    assert all(("DELTA_BINARY_PACKED" in c.encodings) == (encoding == "delta") for c in ids)
    some = read_tokens(spark, path, (), F.col("doc_id").between(150, 160))
    assert "ids" not in some.columns and some.count() == 11
    assert "PushedFilters: [IsNotNull(doc_id), GreaterThanOrEqual(doc_id,150)" in some._jdf.queryExecution().toString()
    with pytest.raises(ValueError):
        write_tokens(docs, path, PATH, encoding="plain")


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    path = shared_folder(spark, "tokens")
    write_tokens(docs, path, PATH)
    assert pack(docs, PATH).collect() == []
    assert sharded(docs).collect() == []


def check_shards(rows, shards, total):
    counts = defaultdict(list)
    for shard, slot in rows:
        counts[shard].append(slot)
    assert all(sorted(s) == list(range(len(s))) for s in counts.values())
    sizes = [len(counts.get(s, ())) for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1 and sum(sizes) == total


def test_sharding_query(spark):
    rows = QUERIES["op5_sharding"](spark, FOLDER).collect()
    docs = documents(spark)
    check_shards([(r.shard, r.slot) for r in rows], 8, len(docs))
    want = {(r.doc_id, len(r.text.encode()) + 1, zlib.crc32(r.text.encode()), "rows", None) for r in docs}
    assert {(r.doc_id, r.size, r.text_crc32, r.law, r.grown_shard) for r in rows} == want


def test_a_repeated_id_scatters(spark):
    """Rows of one id, or of none, with texts of their own spread over all buckets."""
    rows = [(7 if i % 3 else None, f"text {i} " + "x" * 90) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = docs.groupBy(_bucket(30, 42).alias("bucket")).count().collect()
    assert len(found) == 30 and max(r["count"] for r in found) < 60
    out = sharded(docs, 4, bucket_bytes=2000).collect()
    check_shards([(r.shard, r.slot) for r in out], 4, len(rows))
    assert sorted(map(str, ((r.row.doc_id, r.row.text) for r in out))) == sorted(map(str, rows))


def test_shards_keep_rows_and_repeat(spark):
    rows = [*AWKWARD, *[(1000 + i, "same", i) for i in range(500)]]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, slot bigint")
    first = sharded(docs, 3, bucket_bytes=2000).collect()
    check_shards([(r.shard, r.slot) for r in first], 3, len(rows))
    key = lambda r: (str(r[0]), str(r[1]), r[2])
    assert sorted((tuple(r.row) for r in first), key=key) == sorted(rows, key=key)
    again = sharded(docs.repartition(5), 3, bucket_bytes=2000).collect()
    place = lambda found: sorted((r.shard, r.slot, str(r.row)) for r in found)
    assert place(first) == place(again)
    assert place(first) != place(sharded(docs, 3, seed=7, bucket_bytes=2000).collect())


def test_permutations_are_even():
    seen = defaultdict(int)
    for seed in range(6000):
        seen[tuple(fisher_yates(3, seed, 0).tolist())] += 1
    assert len(seen) == 6 and min(seen.values()) > 850
    assert fisher_yates(0, 1, 1).tolist() == [] and fisher_yates(1, 1, 1).tolist() == [0]


def loop_best_fit(lengths, capacity):
    """The rule, bin by bin."""
    left, out = [], []
    most = (capacity.tokens, capacity.pieces, capacity.attention)
    for n in lengths:
        need = (n, 1, n * n)
        costs = []
        for b, rest in enumerate(left):
            if all(r >= d for r, d in zip(rest, need, strict=True)):
                parts = [
                    w * ((r - d) ** 2 if capacity.rule == "norm" else r * d) / m**2
                    for w, r, d, m in zip(capacity.weights, rest, need, most, strict=True)
                ]
                costs.append((sum(parts), b))
        if costs:
            best = min(c for c, _ in costs)
            at = next(b for c, b in costs if c <= best * (1 + 1e-12))
        else:
            at = len(left)
            left.append(list(most))
        out.append((at, capacity.tokens - left[at][0]))
        left[at] = [r - d for r, d in zip(left[at], need, strict=True)]
    return out


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_best_fit(rule):
    draw = np.random.default_rng(5)
    lengths = np.sort(draw.integers(1, 90, 400))[::-1]
    for capacity in (Capacity(100, 5, 10_000, rule=rule), Capacity(100, 100, 10_000, (1.0, 0.3, 0.2), rule)):
        bins, offsets = best_fit(lengths, capacity)
        got = list(zip(bins.tolist(), offsets.tolist(), strict=True))
        assert len({b for b, _ in got}) == len({b for b, _ in loop_best_fit(lengths.tolist(), capacity)})
        assert got == [(b, int(o)) for b, o in loop_best_fit(lengths.tolist(), capacity)]


def check_packing(rows, docs, capacity):
    bins, parts = defaultdict(list), defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
        parts[r.doc_id].append((r.piece, r.start, r.length, r.ids_crc32))
    for held in bins.values():
        held.sort()
        assert [o for o, _ in held] == np.cumsum([0, *[n for _, n in held[:-1]]]).tolist()
        assert sum(n for _, n in held) <= capacity.tokens and len(held) <= capacity.pieces
        assert sum(n * n for _, n in held) <= capacity.attention
    for doc, text in docs:
        ids = ids_of(text)
        cuts = range(0, len(ids), capacity.tokens)
        want = [(p, s, len(ids[s : s + capacity.tokens]), crc(ids[s : s + capacity.tokens])) for p, s in enumerate(cuts)]
        assert sorted(parts[doc]) == want
    return len(bins)


def test_packing_query(spark):
    docs = [(r.doc_id, r.text) for r in documents(spark, "/root/testdata/sf0.01")]
    rows = QUERIES["op6_packing"](spark, "/root/testdata/sf0.01").collect()
    used = check_packing(rows, docs, Capacity())
    assert used <= -(-sum(len(ids_of(t)) for _, t in docs) // 4096) + 3


def test_packing_small(spark):
    rows = [r for r in AWKWARD if r[0] is not None][:-2] + [(50 + i, "few words here", 1) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, length bigint")
    capacity = Capacity(64, 7, 64 * 64)
    packed = pack(docs, PATH, capacity)
    check_packing(packed.collect(), [(i, t) for i, t, _ in rows], capacity)
    whole = {r.sequence_id: (r.n_pieces, len(r.ids)) for r in sequences(packed).collect()}
    assert sum(n for _, n in whole.values()) == sum(len(ids_of(t)) for _, t, _ in rows)
    assert all(n <= 64 for _, n in whole.values())
    with pytest.raises(ValueError):
        pack(docs, PATH, Capacity(64, 7, 100))


def test_packing_odd_ids(spark):
    docs = spark.createDataFrame([(None, "a"), (None, None), (1, "b"), (1, "b")], "doc_id bigint, text string")
    rows = pack(docs, PATH).collect()
    assert sorted((str(r.doc_id), r.length) for r in rows) == [("1", 2), ("1", 2), ("None", 1), ("None", 2)]
    assert len({r.sequence_id for r in rows}) == 1 and sorted(r.offset for r in rows) == [0, 2, 4, 6]


def test_tiny_texts_fill_sequences(spark):
    """8,192 empty texts have one id each and fill two sequences."""
    docs = spark.range(8192).selectExpr("id AS doc_id", "CAST(NULL AS STRING) AS text")
    packed = pack(docs, PATH, with_ids=False)
    assert "ids" not in packed.columns
    sizes = [r["count"] for r in packed.groupBy("sequence_id").count().collect()]
    assert sizes == [4096, 4096]
