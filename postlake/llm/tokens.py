"""Token ids of whole texts with a given tokenizer file, encoded word by word."""

from __future__ import annotations

import os
import re
import zlib
from functools import lru_cache, reduce
from itertools import compress, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

from postlake.llm.common import text_slices

_WORDS_KEPT = 700_000
_WORDS_AT_ONCE = 20_000
_BYTES_AT_ONCE = 4 << 20
# Between an ASCII letter and an ASCII sign or digit, apostrophes aside.
_BORDER = re.compile(rb"(?<=[a-z])(?=[!-&(-@\[-`{-~])|(?<=[!-&(-@\[-`{-~])(?=[a-z])")
# Letters below U+0250, which the library does not take apart.
_PLAIN = re.compile("[A-Za-z\u00aa\u00b5\u00ba\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+").fullmatch


def vocabulary(name: str) -> str:
    """Where a public tokenizer file lies on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


_KEPT_MARKS = (b"<|", b"\xcc", b"\xcd")


def _kept_whole(text: bytes) -> bool:
    """Whether there may be a special token, or a mark that combines with the letter before it."""
    return any(mark in text for mark in _KEPT_MARKS)


class WordEncoder:
    """Ids of texts, each distinct word sent to the tokenizers library once.

    For tokenizers that lower the case, drop white space, never join a letter with what is none, and
    mark the end of a word in its last id, so that the ids of a text are those of its parts;
    ``word_bpe_49k.json`` is one. Texts are cut at ASCII white space, and a word that is new also between
    ASCII letters and ASCII signs or digits; other characters and apostrophes stay within what the
    library sees. What may hold special tokens or combining marks keeps its case and is not cut further.
    When the cache of words is full, the rare ones go.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._library = Tokenizer.from_file(path)
        size = self._library.get_vocab_size()
        self._ends = np.array([(self._library.id_to_token(i) or "").endswith("</w>") for i in range(size)])
        self._place: dict[bytes, int] = {}
        self._ids = np.empty(0, np.int32)
        self._size = np.empty(0, np.int32)
        self._start = np.empty(0, np.int32)
        self._uses = np.empty(0, np.int32)

    def _forget_rare(self) -> None:
        """Keep the words used more than once, half a cache of them at most."""
        kept = np.flatnonzero(self._uses > 1)
        kept = np.sort(kept[np.argsort(-self._uses[kept], kind="stable")[: _WORDS_KEPT // 2]])
        names = list(self._place)
        ids, total = self._gathered(kept)
        self._place, self._ids, self._size = {}, np.empty(0, np.int32), np.empty(0, np.int32)
        self._uses = np.empty(0, np.int32)
        self._add([names[i] for i in kept.tolist()], ids, np.diff(total))

    def _together(self, words: list[str]) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids and their number for words that should have one end mark each, or None if they don't."""
        ids = np.array(self._library.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids, np.int32)
        sizes = np.diff(np.flatnonzero(self._ends[ids]), prepend=-1)
        return (ids, sizes) if len(sizes) == len(words) else None

    def _apart(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        lists = [e.ids for e in self._library.encode_batch_fast(words, add_special_tokens=False)]
        sizes = np.fromiter(map(len, lists), np.int64, len(lists))
        return np.fromiter((i for x in lists for i in x), np.int32, sizes.sum()), sizes

    def _add(self, words: list[bytes], ids: np.ndarray, sizes: np.ndarray) -> None:
        self._place.update(zip(words, range(len(self._place), len(self._place) + len(words)), strict=True))
        self._ids, self._size = np.append(self._ids, ids), np.append(self._size, sizes.astype(np.int32))
        self._start = np.cumsum(self._size, dtype=np.int32) - self._size
        self._uses = np.append(self._uses, np.zeros(len(words), np.int32))

    def _gathered(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of known words one after another, and where each word's ids end, from 0 on."""
        sizes = self._size[at]
        total = np.concatenate(([0], np.cumsum(sizes)))
        return self._ids[np.arange(total[-1]) + np.repeat(self._start[at] - total[:-1], sizes)], total

    def _learn(self, words: list[bytes]) -> None:
        """Add new words; they are cut, decoded and told apart all at once, for most words occur once."""
        uncut = [w for w in words if _kept_whole(w)] if _kept_whole(b"\n".join(words)) else []
        set_aside = set(uncut)
        others = [w for w in words if w not in set_aside] if uncut else words
        pieces = _BORDER.sub(b" ", b"\n".join(others)).split(b"\n") if others else []
        cut = {w: p.split(b" ") for w, p in zip(others, pieces, strict=True) if b" " in p}
        whole = [w for w in others if w not in cut] if cut else others
        parts = (p for found in cut.values() for p in found if p not in self._place)
        names = list(dict.fromkeys([*uncut, *whole, *parts]))
        texts = b"\n".join(names).decode().split("\n") if names else []
        plain = [m is not None for m in map(_PLAIN, texts)]
        for chosen, encode in ((plain, self._together), ([not p for p in plain], self._apart)):
            known, asked = list(compress(names, chosen)), list(compress(texts, chosen))
            for begin in range(0, len(known), _WORDS_AT_ONCE):
                some = asked[begin : begin + _WORDS_AT_ONCE]
                self._add(known[begin : begin + _WORDS_AT_ONCE], *(encode(some) or self._apart(some)))
        if cut:
            at = np.array([self._place[p] for found in cut.values() for p in found])
            ids, total = self._gathered(at)
            self._add(list(cut), ids, np.diff(total[np.cumsum([0, *map(len, cut.values())])]))

    def encode(self, texts: list[bytes] | pa.Array, end_id: int | None) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after another, and how many belong to each text; every text ends with ``end_id``."""
        texts = pa.array(texts, pa.binary()) if isinstance(texts, list) else texts.fill_null(b"")
        kept = reduce(pc.or_, [pc.match_substring(texts, mark) for mark in _KEPT_MARKS])
        plain = texts.cast(pa.string())
        split = pc.ascii_split_whitespace(pc.if_else(kept, plain, pc.ascii_lower(plain)))
        ends_of_texts = np.cumsum(split.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)
        if len(self._place) > _WORDS_KEPT:
            self._forget_rare()
        if b"" not in self._place:  # white space at the ends of a text gives empty words
            self._add([b""], np.empty(0, np.int32), np.zeros(1, np.int64))
        coded = split.flatten().cast(pa.binary()).dictionary_encode()
        words = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        places = np.fromiter(map(self._place.get, words, repeat(-1)), np.int64, len(words))
        new = np.flatnonzero(places < 0).tolist()
        if new:
            asked = [words[i] for i in new]
            self._learn(asked)
            places[new] = [self._place[w] for w in asked]
        at = places[coded.indices.to_numpy(zero_copy_only=False)]
        self._uses += np.bincount(at, minlength=len(self._uses)).astype(np.int32)
        ids, total = self._gathered(at)
        ends = total[ends_of_texts]
        lengths = np.diff(ends, prepend=0)
        if end_id is not None:
            ids = np.insert(ids, ends, end_id)
            lengths = lengths + 1
        return ids.astype(np.int32, copy=False), lengths


@lru_cache(maxsize=2)
def encoder(path: str) -> WordEncoder:
    """One encoder for each file and Python worker."""
    return WordEncoder(path)


def encode_column(texts: pa.Array, path: str, end_id: int | None) -> tuple[np.ndarray, np.ndarray]:
    """As :meth:`WordEncoder.encode` for an Arrow column of texts, some MB at a time; null counts as empty."""
    parts = [encoder(path).encode(some, end_id) for some in text_slices(texts.cast(pa.binary()), _BYTES_AT_ONCE)]
    nothing = (np.empty(0, np.int32), np.empty(0, np.int64))
    ids, lengths = zip(*[nothing, *parts], strict=True)
    return np.concatenate(ids), np.concatenate(lengths)


def crc_of(ids: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[int]:
    """Unsigned crc32 of stretches of ids as little-endian unsigned 32-bit integers."""
    raw = memoryview(np.ascontiguousarray(ids, "<i4")).cast("B")
    return [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]


def ids_crc32(ids: Column) -> Column:
    @F.arrow_udf("bigint")
    def crc(lists: pa.Array) -> pa.Array:
        offsets = lists.offsets.to_numpy().astype(np.int64)
        values = lists.values.to_numpy(zero_copy_only=False)
        return pa.array(crc_of(values, offsets[:-1], offsets[1:]), pa.int64())

    return crc(ids)
