"""Pieces against the sentencepiece library, and exact round trips with dropout."""

import random
import zlib

import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from postlake.llm.piece_codec import PieceCodec, decode_pieces, encode_pieces
from postlake.llm.queries import PIECE_MODEL, QUERIES
from postlake.llm.tokens import vocabulary

FOLDER = "/root/testdata/sf0.001"
PATH = vocabulary(PIECE_MODEL)
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PATH)
PLAIN, MIXED = PieceCodec(PATH, 42, 0.0), PieceCodec(PATH, 42, 0.3)
TEXT = st.text(st.one_of(st.characters(exclude_categories=["Cs"]), st.sampled_from("  \n\taest.é")), max_size=40)


@settings(max_examples=400, deadline=None)
@given(TEXT)
def test_without_dropout_as_the_library(text):
    text = text.replace("▁", "_").replace("\0", "0")
    assert PLAIN.encode(text, 1).tolist() == LIBRARY.encode(text)


@settings(max_examples=400, deadline=None)
@given(TEXT, st.integers(-(2**63), 2**63 - 1))
def test_round_trips(text, key):
    for codec in (PLAIN, MIXED):
        assert codec.decode(codec.encode(text, key)) == text.encode()


def loop_segment(codec, chunk, variant):
    """The agenda as a list that is searched anew for every merge."""
    symbols = [[c, i] for i, c in enumerate(chunk.replace(" ", "▁"))]
    skipped, waiting = set(), set()

    def look(i):
        if 0 <= i < len(symbols) - 1 and symbols[i][0] + symbols[i + 1][0] in codec.rank:
            waiting.add((codec.rank[symbols[i][0] + symbols[i + 1][0]], symbols[i][1], symbols[i + 1][1]))

    for i in range(len(symbols)):
        look(i)
    while waiting:
        best = min(waiting)
        waiting.discard(best)
        at = next((n for n, s in enumerate(symbols) if s[1] == best[1]), None)
        if at is None or at + 1 >= len(symbols) or symbols[at + 1][1] != best[2]:
            continue
        pair = symbols[at][0] + symbols[at + 1][0]
        if codec.rank.get(pair) != best[0] or best in skipped:
            continue
        if codec._skips[variant][(best[0] * 40503 + best[1] * 2057) % 65536]:
            skipped.add(best)
            continue
        symbols[at : at + 2] = [[pair, best[1]]]
        look(at - 1)
        look(at)
    return [i for s, _ in symbols for i in ([codec.ids[s]] if s in codec.ids else [codec.byte[b] for b in s.encode()])]


def test_dropout_by_the_plain_agenda():
    words = "thernd overwhelming unbelievable internationalisation mississippi banana aaaaaaaaaa été 漢字かな".split()
    for word in words:
        for variant in range(3):
            want = loop_segment(MIXED, " " + word, variant)
            assert list(MIXED.segment(" " + word, variant)) == want
            long = MIXED._merge_long(list("▁" + word), MIXED._skips[variant])
            assert long == MIXED._merge_short(list("▁" + word), MIXED._skips[variant])


def test_dropout_varies_and_repeats():
    text = "internationalisation of unbelievable information " * 50
    one, other = MIXED.encode(text, 1), MIXED.encode(text, 2)
    again, seeded = PieceCodec(PATH, 42, 0.3).encode(text, 1), PieceCodec(PATH, 7, 0.3).encode(text, 1)
    assert np.array_equal(one, again) and not np.array_equal(one, other) and not np.array_equal(one, seeded)
    assert len(one) > len(PLAIN.encode(text, 1))
    assert all(abs(sum(table) / len(table) - 0.3) < 0.01 for table in MIXED._skips)


def test_registered_query(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    codec = PieceCodec(PATH, 42, 0.1)
    got = QUERIES["op1_sentencepiece"](spark, FOLDER).collect()
    assert len(got) == len(docs)
    for r in got:
        ids = codec.encode(docs[r.doc_id], r.doc_id)
        assert (r.n_ids, r.ids_crc32) == (len(ids), zlib.crc32(ids.astype("<u4").tobytes()))
        assert r.text_crc32 == zlib.crc32(docs[r.doc_id].encode())


def test_awkward_rows(spark):
    texts = [None, "", " ", "\n\n", "▁ and <▁>", "😀", "word " * 50_000, "x" * 20_000, "  two  spaces ", "\r\n\t\0"]
    rows = [(i, t, "x") for i, t in enumerate(texts)] + [(None, "no id", "x"), (3, "\n\n", "x")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, ids string")
    got = encode_pieces(docs, PATH).withColumn("back", decode_pieces("ids", PATH)).collect()
    assert sorted((str(r.doc_id), r.back) for r in got) == sorted((str(i), t or "") for i, t, _ in rows)
    assert encode_pieces(docs.limit(0), PATH).collect() == []


def test_every_occurrence_has_its_own_draws():
    """A cached tree gives what the agenda gives for each occurrence, and one in ten candidates is skipped."""
    codec = PieceCodec(PATH, 42, 0.1)
    words = "the of Internationalisation " + "mississippi" * 4 + " 漢字かな ▁ 12345.67 unbelievable\n"
    for key in (1, 2, -5):
        chunks, draws = codec.occurrences(words * 30, key)
        want = [i for c, d in zip(chunks, draws.tolist(), strict=True) for i in codec.segment(c, d)]
        assert codec.encode(words * 30, key).tolist() == want
    chunk = next(c for c in (" a", " b", " c", " d", " e") if len(codec._segment(c, [False] * 65536)) == 1)
    whole, total = len(codec._segment(chunk, [False] * 65536)), 4000
    split = sum(len(codec.encode(chunk[1:], key)) > whole for key in range(total))
    assert 0.08 * total < split < 0.12 * total
    inside = codec.encode(chunk[1:] + chunk * (total - 1), 7)
    assert 0.08 * total < len(inside) - total < 0.12 * total
    assert len({tuple(codec.encode("internationalisation", key)) for key in range(200)}) > 20


@pytest.mark.parametrize("dropout", [0.0, 0.1, 0.5, 1.0])
def test_agendas_run_together_as_one_by_one(monkeypatch, dropout):
    """Chunks of every size, also in small parts, get the ids of their own agendas."""
    pick = random.Random(3)
    kana = "".join(map(chr, range(0x3041, 0x3097))) + "漢字日本語的是不了ab1."
    words = ["a", "the", "mississippi" * 3, "x▁y", "▁", "<▁>", "😀", "\t", "12345.67,", "=-" * 20, "\n\n"]
    texts = ["".join(pick.choices(kana, k=k)) for k in range(1, 160) for _ in range(2)]
    texts += [" ".join(pick.choices(words, k=200)) for _ in range(20)]
    keys = [pick.randrange(-(2**63), 2**63) for _ in texts]
    codec = PieceCodec(PATH, 42, dropout)
    want = []
    for text, key in zip(texts, keys, strict=True):
        chunks, draws = codec.occurrences(text, key)
        want.append([i for c, d in zip(chunks, draws.tolist(), strict=True) for i in codec.segment(c, d)])
    for at_once in (1 << 21, 3000):
        monkeypatch.setattr("postlake.llm.piece_codec._AT_ONCE", at_once)
        ids, sizes = codec.encode_all(texts, keys)
        assert [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])] == want


def test_candidates_of_one_slot_draw_apart(monkeypatch):
    """All candidates of a chunk in one slot: the second to ask it has a draw of its own, as one by one."""
    for name in ("_RANK", "_PLACE"):
        monkeypatch.setattr(f"postlake.llm.piece_codec.{name}", 0)
    codec = PieceCodec(PATH, 42, 0.3)
    text = "internationalisation of unbelievable mississippi " * 100
    chunks, draws = codec.occurrences(text, 5)
    want = [i for c, d in zip(chunks, draws.tolist(), strict=True) for i in codec.segment(c, d)]
    assert codec.encode(text, 5).tolist() == want


def test_few_agendas_run_in_python(monkeypatch):
    """New words cost no Python agenda each: of 20,000 made-up ones, only sizes with few chunks run one by one."""
    pick = random.Random(4)
    text = " ".join("".join(pick.choices("abcdefghijklmnoprstuvwyz", k=pick.randint(3, 12))) for _ in range(20_000))
    codec, runs = PieceCodec(PATH, 42, 0.1), []
    for name in ("_merge_short", "_merge_long"):
        run = getattr(codec, name)
        monkeypatch.setattr(codec, name, lambda symbols, skips, run=run: runs.append(1) or run(symbols, skips))
    assert codec.decode(codec.encode(text, 1)) == text.encode()
    assert len(runs) < 200
