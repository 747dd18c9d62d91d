"""SentencePiece encoding with seeded merge-dropout, and decoding."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlake.llm.common import batch_slices

SEED = 42
DROPOUT = 0.1
_SPACE = "▁"
#: Stands for a space mark in the text itself, which is written as bytes so that it is no space when decoded.
_LITERAL = f"<{_SPACE}>"
# No piece has a space mark behind another sign, a line break, or a Latin letter next to an ASCII sign or digit, so
# nothing merges across the borders of chunks. What touches other signs is cut at spaces and line breaks only.
_LETTERS = "A-Za-zÀ-ÖØ-öø-ɏ"
_OTHERS = rf"(?![^\x00-\x7f{_LETTERS}])"
_CHUNK = re.compile(rf"\n| *[{_LETTERS}]++{_OTHERS}| *[\x00-\x09\x0b-\x1f!-@\[-`{{-\x7f]++{_OTHERS}| *[^ \n]+| +")
_AT_ONCE = 1 << 21
_LONG = 48
_NEVER = 1 << 60
# The agendas of chunks of like sizes run together, up to a number; those of a few, or of longer chunks, one by one.
_SIZES = (2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 13, 15, 18, 22, 27, 34, 41, 49, 58, 69, 82, 97, 113, 129)
_COLUMNS = 1 << 14
_FEW = 48
# An entry of their agendas is a rank and, in its lowest bits, a place.
_BITS = 7
_ABSENT = (1 << 31) - 1
_GONE = -1
_SLOTS = 1 << 16
_FULL = (1 << 64) - 1
# Odd multipliers that spread ranks, places and documents.
_RANK, _PLACE, _STEP, _MIX = 40503, 2057, 0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijective hash of 64-bit words, in place."""
    x ^= x >> np.uint64(30)
    x *= np.uint64(_MIX)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class _Draws:
    """Which candidates one occurrence of a chunk skips. A slot asked again is another candidate of the chunk."""

    def __init__(self, key: int, least: int) -> None:
        self._key, self._least, self._asked = key, least, {}

    def __len__(self) -> int:
        return _SLOTS

    def __iter__(self) -> Iterator[bool]:
        codes = np.arange(_SLOTS, dtype=np.uint64) * np.uint64(_STEP) + np.uint64(self._key)
        return iter((_mixed(codes) < np.uint64(self._least)).tolist())

    def __getitem__(self, slot: int) -> bool:
        again = self._asked[slot] = self._asked.get(slot, -1) + 1
        x = ((slot + again * _SLOTS) * _STEP + self._key) & _FULL
        x = ((x ^ (x >> 30)) * _MIX) & _FULL
        x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & _FULL
        return x ^ (x >> 31) < self._least


class _AllDraws:
    """The draws of every key; iteration gives those of a few."""

    def __init__(self, dropout: float) -> None:
        self.least = min(_FULL, int(dropout * (1 << 64)))

    def __getitem__(self, key: int) -> _Draws:
        return _Draws(key, self.least)

    def __iter__(self) -> Iterator[_Draws]:
        return (self[key] for key in range(4))


class _Pairs:
    """The ranks of adjacent symbols that make a piece, as agenda entries for place 0, by open addressing."""

    def __init__(self, pairs: dict[tuple[int, int], int]) -> None:
        bits = (4 * len(pairs)).bit_length()
        self._shift, self._last = np.uint64(64 - bits), (1 << bits) - 1
        self._keys, self._ranks = np.full(1 << bits, -1, np.int64), np.full(1 << bits, _ABSENT, np.int32)
        both = np.array([*pairs], np.int64).reshape(-1, 2)
        keys, ranks = both[:, 0] << 32 | both[:, 1], np.fromiter(pairs.values(), np.int32, len(pairs)) << _BITS
        slots = self._slots(keys)
        while len(keys):
            free = self._keys[slots] < 0
            self._keys[slots[free]] = keys[free]
            placed = self._keys[slots] == keys
            self._ranks[slots[placed]] = ranks[placed]
            keys, ranks, slots = keys[~placed], ranks[~placed], (slots[~placed] + 1) & self._last

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * np.uint64(_STEP)) >> self._shift).view(np.int64)

    def entries(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The entry of each pair; ``_ABSENT`` if it makes no piece."""
        keys = left.astype(np.int64) << 32 | right
        slots = self._slots(keys)
        found = self._keys[slots]
        out = self._ranks[slots]
        which = np.flatnonzero((found != keys) & (found >= 0))
        slots = slots[which]
        while len(which):
            slots = (slots + 1) & self._last
            found = self._keys[slots]
            out[which] = self._ranks[slots]
            on = (found != keys[which]) & (found >= 0)
            which, slots = which[on], slots[on]
        return out


class PieceCodec:
    """Merges, byte fallback and decoding of a SentencePiece BPE model file, with merge-dropout.

    Adjacent symbols that make a piece wait in an agenda, best score first, then leftmost. With dropout a
    candidate that comes up is skipped when a hash of seed, document, place of the chunk, piece and place
    in the chunk says so, and stays out unless a neighbour changes. Without it the ids are those of the
    sentencepiece library.

    Every occurrence of a chunk runs its agenda with draws of its own. Those of like sizes run together: in each
    round the best candidate of each is merged or skipped. Long chunks, and sizes with few, run one by one.
    """

    def __init__(self, path: str, seed: int, dropout: float) -> None:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        whole = [i for i in range(size) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
        self.ids = {model.id_to_piece(i): i for i in whole}
        if any(len(_CHUNK.findall(p.replace(_SPACE, " "))) > 1 for p in self.ids):
            raise ValueError("pieces that span words, lines or kinds of signs are not supported")
        order = sorted(whole, key=lambda i: -model.get_score(i))
        self.rank = {model.id_to_piece(i): n for n, i in enumerate(order)}
        self.byte = {int(model.id_to_piece(i)[3:5], 16): i for i in range(size) if model.is_byte(i)}
        raw = [b""] * size
        for piece, i in self.ids.items():
            raw[i] = piece.replace(_SPACE, " ").encode()
        for value, i in self.byte.items():
            raw[i] = bytes([value])
        self._sizes = np.fromiter(map(len, raw), np.int64, size)
        self._starts = np.cumsum(self._sizes) - self._sizes
        self._raw = np.frombuffer(b"".join(raw), np.uint8)
        self._seed, self._drops = int(_mixed(np.array([seed % (1 << 64)], np.uint64))[0]), dropout > 0
        self._skips = _AllDraws(dropout)
        # Symbols have their ranks as numbers, then come signs that are only part of pieces, then one number for all else.
        parts = sorted(set("".join(self.ids)) - self.ids.keys())
        self._numbers = symbols = self.rank | {c: len(order) + n for n, c in enumerate(parts)}
        self._unknown = len(symbols)
        self._ids = np.array(order, np.int32)
        self._signs = np.full(0x110000, self._unknown, np.int32)
        for symbol, n in symbols.items():
            if len(symbol) == 1:
                self._signs[ord(symbol)] = n
        self._signs[ord(" ")], self._signs[ord(_SPACE)] = symbols.get(_SPACE, self._unknown), self._unknown
        self._pairs = _Pairs({
            (symbols[piece[:i]], symbols[piece[i:]]): n
            for piece, n in self.rank.items()
            for i in range(1, len(piece))
            if piece[:i] in symbols and piece[i:] in symbols
        })

    def segment(self, chunk: str, key: int) -> tuple[int, ...]:
        """Ids of one occurrence of a chunk, with the draws of ``key``."""
        return self._segment(chunk, self._skips[key])

    def _merged(self, chunk: str, skips: _Draws) -> list[str]:
        if _SPACE in chunk:
            symbols = [_LITERAL if c == _SPACE else _SPACE if c == " " else c for c in chunk]
        else:
            symbols = list(chunk.replace(" ", _SPACE))
        merge = self._merge_long if len(symbols) > _LONG else self._merge_short
        return merge(symbols, skips)

    def _segment(self, chunk: str, skips: _Draws) -> tuple[int, ...]:
        out: list[int] = []
        for symbol in self._merged(chunk, skips):
            known = self.ids.get(symbol)
            if known is not None:
                out.append(known)
            else:
                out.extend(self.byte[b] for b in (_SPACE if symbol == _LITERAL else symbol).encode())
        return tuple(out)

    def _merge_short(self, symbols: list[str], skips: _Draws) -> list[str]:
        """The agenda of a short chunk as a list of the ranks of adjacent pairs."""
        rank, places = self.rank.get, list(range(len(symbols)))
        agenda = [rank(a + b, _NEVER) for a, b in zip(symbols, symbols[1:], strict=False)]
        while agenda:
            best = min(agenda)
            if best == _NEVER:
                break
            at = agenda.index(best)
            if skips[(best * _RANK + places[at] * _PLACE) & (_SLOTS - 1)]:
                agenda[at] = _NEVER
                continue
            pair = symbols[at] + symbols[at + 1]
            symbols[at : at + 2] = [pair]
            del agenda[at], places[at + 1]
            if at < len(agenda):
                agenda[at] = rank(pair + symbols[at + 1], _NEVER)
            if at:
                agenda[at - 1] = rank(symbols[at - 1] + pair, _NEVER)
        return symbols

    def _merge_long(self, symbols: list[str], skips: _Draws) -> list[str]:
        """The agenda of a long chunk as a heap."""
        count, rank = len(symbols), self.rank
        after, before = list(range(1, count + 1)), list(range(-1, count - 1))
        agenda = []
        for i in range(count - 1):
            pair = symbols[i] + symbols[i + 1]
            if pair in rank:
                agenda.append((rank[pair], i, pair))
        heapify(agenda)
        while agenda:
            r, i, pair = heappop(agenda)
            j = after[i]
            if j >= count or not symbols[i] or symbols[i] + symbols[j] != pair:
                continue
            if skips[(r * _RANK + i * _PLACE) & (_SLOTS - 1)]:
                continue
            symbols[i], symbols[j] = pair, ""
            right = after[i] = after[j]
            if right < count:
                before[right] = i
                wider = pair + symbols[right]
                if wider in rank:
                    heappush(agenda, (rank[wider], i, wider))
            left = before[i]
            if left >= 0:
                wider = symbols[left] + pair
                if wider in rank:
                    heappush(agenda, (rank[wider], left, wider))
        return [s for s in symbols if s]

    def occurrences(self, text: str, key: int) -> tuple[list[str], np.ndarray]:
        """The chunks of a text, and for each the key of its draws: seed, document and place, hashed."""
        chunks = _CHUNK.findall(" " + text) if text else []
        document = _mixed(np.array([(key * _STEP + self._seed) % (1 << 64)], np.uint64))
        return chunks, _mixed(np.arange(len(chunks), dtype=np.uint64) * np.uint64(_STEP) + document)

    def encode(self, text: str, key: int) -> np.ndarray:
        """Ids of a text; ``key`` stands for its document."""
        return self.encode_all([text], [key])[0]

    def encode_all(self, texts: list[str], keys: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts, one behind the other, and how many each has."""
        split = [self.occurrences(t, k) for t, k in zip(texts, keys, strict=True)]
        chunks = list(chain.from_iterable(c for c, _ in split))
        draws = np.concatenate([*(d for _, d in split), np.empty(0, np.uint64)])
        sizes = np.fromiter(map(len, chunks), np.int64, len(chunks))
        cuts = [0, *np.flatnonzero(np.diff(np.cumsum(sizes) // _AT_ONCE, prepend=0)).tolist(), len(chunks)]
        parts = [self._encode_chunks(chunks[a:b], sizes[a:b], draws[a:b]) for a, b in pairwise(cuts) if a < b]
        ids = np.concatenate([*(p for p, _ in parts), np.empty(0, np.int32)])
        ends = np.concatenate([[0], np.cumsum(np.concatenate([*(n for _, n in parts), np.empty(0, np.int64)]))])
        borders = ends[np.cumsum([0, *(len(c) for c, _ in split)])]
        return ids, np.diff(borders)

    def _encode_chunks(
        self, chunks: list[str], sizes: np.ndarray, draws: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        """Ids of chunks, one behind the other, and how many each has."""
        signs = np.frombuffer("".join(chunks).encode("utf-32-le"), np.uint32)
        ends = np.cumsum(sizes)
        starts = ends - sizes
        symbols = np.append(self._signs[signs], np.full(_SIZES[-1], self._unknown, np.int32))
        after, before = np.arange(1, len(symbols) + 1), np.arange(-1, len(symbols) - 1)
        limited = np.minimum(sizes, _SIZES[-1]).astype(np.uint16)
        order = np.argsort(limited, kind="stable")
        cuts = np.searchsorted(limited[order], np.array(_SIZES, np.uint16))
        for low, high in zip(cuts[:-1], cuts[1:], strict=True):
            if high - low < _FEW:
                self._merge_each(order[low:high], chunks, draws, starts, symbols)
                continue
            for i in range(low, high, _COLUMNS):
                which = order[i : min(i + _COLUMNS, high)]
                self._merge_together(starts[which], sizes[which], draws[which], symbols, after, before)
        self._merge_each(order[cuts[-1] :], chunks, draws, starts, symbols)
        return self._written(symbols[: len(signs)], signs, ends)

    def _merge_each(
        self, which: np.ndarray, chunks: list[str], draws: np.ndarray, starts: np.ndarray, symbols: np.ndarray
    ) -> None:
        """The agendas of some chunks one by one, written into ``symbols``."""
        for i in which.tolist():
            at = int(starts[i])
            symbols[at : at + len(chunks[i])] = _GONE
            for symbol in self._merged(chunks[i], self._skips[int(draws[i])]):
                symbols[at] = self._numbers.get(symbol, self._unknown)
                at += 1 if symbol == _LITERAL else len(symbol)

    def _merge_together(
        self, starts: np.ndarray, sizes: np.ndarray, draws: np.ndarray,
        symbols: np.ndarray, after: np.ndarray, before: np.ndarray,
    ) -> None:
        """The agendas of chunks of like sizes, a column each, a candidate of each in a round.

        ``symbols`` holds at each symbol's first sign its number, elsewhere ``_GONE``; ``after`` and ``before`` hold
        there where its neighbours begin.
        """
        width, ends = int(sizes.max()), starts + sizes
        places = np.arange(width - 1, dtype=np.int32)[:, None]
        at = starts + places
        agenda = np.full((width, len(starts)), _ABSENT, np.int32)  # the last place never has a right neighbour
        agenda[:-1] = self._pairs.entries(symbols[at.ravel()], symbols[at.ravel() + 1]).reshape(at.shape) | places
        agenda[:-1][places >= sizes - 1] = _ABSENT
        asked = np.empty((3 * width, len(starts)), np.uint16)  # each of up to width - 1 merges adds two candidates
        for step in range(3 * width):
            best = agenda.min(axis=0)
            going = np.flatnonzero(best != _ABSENT)
            if not len(going):
                break
            if len(going) < len(best):
                best, starts, ends, draws = best[going], starts[going], ends[going], draws[going]
                agenda = agenda.take(going, axis=1)
                asked[:step, : len(going)] = asked[:step].take(going, axis=1)
                asked = asked[:, : len(going)]
            count, flat = len(best), agenda.reshape(-1)
            rank, place = best >> _BITS, (best & ((1 << _BITS) - 1)).astype(np.int64)
            columns = np.arange(count)
            flat[place * count + columns] = _ABSENT
            if self._drops:
                slots = rank.astype(np.uint16) * np.uint16(_RANK) + place.astype(np.uint16) * np.uint16(_PLACE)
                codes = slots.astype(np.uint64)
                again = np.flatnonzero((asked[:step] == slots).any(axis=0))
                if len(again):
                    codes[again] += (asked[:step, again] == slots[again]).sum(axis=0, dtype=np.uint64) * np.uint64(_SLOTS)
                asked[step] = slots
                codes *= np.uint64(_STEP)
                codes += draws
                columns = np.flatnonzero(_mixed(codes) >= np.uint64(self._skips.least))
                rank, place = rank[columns], place[columns]
            begins = starts[columns]
            here = begins + place
            gone = after[here]
            right = after[gone]
            symbols[here], symbols[gone] = rank, _GONE
            after[here], before[right] = right, here
            flat[(gone - begins) * count + columns] = _ABSENT
            followed, led = np.flatnonzero(right < ends[columns]), np.flatnonzero(place)
            first = np.concatenate([here[followed], before[here[led]]])
            second = np.concatenate([right[followed], here[led]])
            columns = np.concatenate([columns[followed], columns[led]])
            place = first - starts[columns]
            flat[place * count + columns] = self._pairs.entries(symbols[first], symbols[second]) | place.astype(np.int32)

    def _written(self, symbols: np.ndarray, signs: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the symbols that are left, with bytes for unknown signs, and how many each chunk has."""
        present = symbols != _GONE
        left, borders = np.flatnonzero(present), np.cumsum(present)[ends - 1]
        symbols = symbols[left]
        odd = symbols >= len(self._ids)
        ids = self._ids[np.where(odd, 0, symbols)]
        if odd.any():
            kinds, which = np.unique(signs[left[odd]], return_inverse=True)
            spelled = [[self.byte[b] for b in chr(c).replace(" ", _SPACE).encode()] for c in kinds.tolist()]
            more = np.ones(len(ids), np.int64)
            more[odd] = np.array([len(x) for x in spelled])[which]
            ids = np.repeat(ids, more)
            ids[np.repeat(odd, more)] = [*chain.from_iterable(spelled[i] for i in which.tolist())]
            borders = np.append(0, np.cumsum(more))[borders]
        return ids, np.diff(borders, prepend=0)

    def decode(self, ids: np.ndarray) -> bytes:
        """The text of ids, without the space that encoding puts first."""
        sizes = self._sizes[ids]
        ends = np.cumsum(sizes)
        at = np.repeat(self._starts[ids] - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)
        return self._raw[at].tobytes()[1:]


@lru_cache(maxsize=2)
def codec(path: str, seed: int, dropout: float) -> PieceCodec:
    """One codec for each model, seed and Python worker."""
    return PieceCodec(path, seed, dropout)


def encode_pieces(docs: DataFrame, model: str, seed: int = SEED, dropout: float = DROPOUT) -> DataFrame:
    """``(doc_id, ids)`` of every row of ``docs(doc_id, text, …)``.

    Each candidate merge is skipped with probability ``dropout``, decided by a keyed hash: the same seed,
    id and text give the same ids on any cluster, another seed other ones. Every occurrence of a chunk
    (letters or other signs in a row, with the spaces before them) has draws of its own, from the id and
    its place in the text. Null and empty texts have no ids; a null id counts as 0; repeated rows give equal rows;
    other columns are ignored; an empty table gives no rows.
    """

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(model, seed, dropout)
        for batch in batch_slices(batches, "text", 1 << 20):
            texts, keys = batch.column("text"), batch.column("doc_id")
            found, sizes = coder.encode_all([t.as_py() or "" for t in texts], [k.as_py() or 0 for k in keys])
            offsets = np.cumsum([0, *sizes]).astype(np.int32)
            flat = pa.array(found)
            ids = pa.ListArray.from_arrays(pa.array(offsets), flat)
            yield pa.RecordBatch.from_arrays([keys, ids], ["doc_id", "ids"])

    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", "text").mapInArrow(encoded, f"doc_id {kind}, ids array<int>")


def decode_pieces(ids: Column, model: str) -> Column:
    """The texts of id lists; null for null."""

    @F.arrow_udf("string")
    def decoded(lists: pa.Array) -> pa.Array:
        coder = codec(model, SEED, DROPOUT)
        values, offsets = lists.values.to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
        valid = lists.is_valid().to_numpy(zero_copy_only=False)
        texts = [
            coder.decode(values[a:b]) if ok else None
            for a, b, ok in zip(offsets[:-1], offsets[1:], valid, strict=True)
        ]
        return pa.array(texts, pa.binary()).cast(pa.string())

    return decoded(ids)
