"""Removal of sentences that repeat in runs across the corpus."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlake.llm.common import batch_slices, stored

#: A sentence ends after its stops or line breaks and the space that follows; sentences add up to the text.
_SENTENCE = re.compile(rb"[^.!?\n]*[.!?\n]+\s*|[^.!?\n]+")
LEAST_SENTENCES = 2
# Only runs of two words, such as 'Yes. No.', may repeat.
LEAST_WORDS = 3
_LAST = (1 << 63) - 1


def sentences(text: bytes) -> list[bytes]:
    return _SENTENCE.findall(text)


def runs(text: bytes, least_sentences: int, least_words: int) -> list[tuple[int, int, int]]:
    """``(first, end, hash)`` of the runs of sentences to compare, ``end`` exclusive.

    From every sentence the shortest run of at least ``least_sentences`` with at least ``least_words``
    words, forwards and backwards; so any passage that holds such a run is covered to both its ends.
    Case and white space do not count, and sentences without a word are passed over.
    """
    found, plain, places = sentences(text), [], []
    for place, sentence in enumerate(found):
        words = sentence.lower().split()
        if words:
            plain.append(words)
            places.append(place)
    sizes = np.fromiter(map(len, plain), np.int64, len(plain))
    total = np.concatenate(([0], np.cumsum(sizes)))
    count = len(plain)
    each = np.arange(count)
    ends = np.maximum(np.searchsorted(total, total[:-1] + least_words), each + least_sentences)
    begins = np.minimum(np.searchsorted(total, total[1:] - least_words, side="right") - 1, each + 1 - least_sentences)
    pairs = {(a, b) for a, b in zip(each.tolist(), ends.tolist(), strict=True) if b <= count}
    pairs |= {(a, b + 1) for a, b in zip(begins.tolist(), each.tolist(), strict=True) if a >= 0}
    joined = [b" ".join(words) for words in plain]
    return [
        (places[a], places[b - 1] + 1, xxhash.xxh3_128_intdigest(b" ".join(joined[a:b]))) for a, b in sorted(pairs)
    ]


def _runs_of(docs: DataFrame, least_sentences: int, least_words: int) -> DataFrame:
    """``(id, version, first, end, high, low)``: the runs of all rows with both halves of their hash."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batch_slices(batches, "text"):
            row, first, end, high, low = [], [], [], [], []
            for place, text in enumerate(batch.column("text").cast(pa.binary())):
                for a, b, h in runs(text.as_py() or b"", least_sentences, least_words):
                    row.append(place)
                    first.append(a)
                    end.append(b)
                    high.append(h >> 64)
                    low.append(h & 0xFFFFFFFFFFFFFFFF)
            at = pa.array(row, pa.int64())
            columns = [batch.column("id").take(at), batch.column("version").take(at)]
            columns += [pa.array(first, pa.int32()), pa.array(end, pa.int32())]
            columns += [pa.array(np.array(x, np.uint64).view(np.int64)) for x in (high, low)]
            yield pa.RecordBatch.from_arrays(columns, ["id", "version", "first", "end", "high", "low"])

    schema = "id bigint, version bigint, first int, end int, high bigint, low bigint"
    return docs.select(*_identity(), "text").mapInArrow(found, schema)


def _identity() -> tuple[Column, Column]:
    """What tells documents apart: the id, those without one last, and a hash of the text."""
    version = F.xxhash64(F.coalesce("text", F.lit("")))
    return F.coalesce(F.col("doc_id").cast("bigint"), F.lit(_LAST)).alias("id"), version.alias("version")


def repeated_sentences(
    docs: DataFrame, least_sentences: int = LEAST_SENTENCES, least_words: int = LEAST_WORDS
) -> DataFrame:
    """``(id, version, spans)``: for each document the sentence ranges that repeat an earlier place.

    A run's first place is the one with the lowest document id, then the earliest in the text. Runs are
    counted before they are joined with their first places, and those are stored, so a run that a third
    of all documents share is split like any hot join key.
    """
    found = _runs_of(docs, least_sentences, least_words)
    place = F.struct("id", "version", "first")
    repeated = found.groupBy("high", "low").agg(F.count("*").alias("_n"), F.min(place).alias("_home"))
    homes = stored(repeated.filter("_n > 1").select("high", "low", "_home"), "repeated-runs")
    later = found.join(homes, ["high", "low"]).filter(place != F.col("_home"))
    span = F.struct(F.col("first"), F.col("end"))
    return later.groupBy("id", "version").agg(F.array_sort(F.collect_set(span)).alias("spans"))


def without_sentences(text: bytes, spans: list[tuple[int, int]]) -> tuple[bytes, int, int]:
    """The text without the sentences of ``spans``, how many it had, and how many went."""
    found = sentences(text)
    gone = np.zeros(len(found) + 1, np.int64)
    for first, end in spans:
        gone[first] += 1
        gone[end] -= 1
    keep = np.cumsum(gone)[:-1] == 0
    return b"".join(s for s, k in zip(found, keep, strict=True) if k), len(found), int((~keep).sum())


def _cleaned(text: Column, spans: Column) -> Column:
    @F.arrow_udf("struct<text: string, n_sentences: int, n_removed: int>")
    def cleaned(texts: pa.Array, spans: pa.Array) -> pa.Array:
        out = [
            without_sentences(t.as_py() or b"", [(x["first"], x["end"]) for x in s.as_py() or ()])
            for t, s in zip(texts.cast(pa.binary()), spans, strict=True)
        ]
        kept, had, gone = zip(*out, strict=True) if out else ((), (), ())
        arrays = [pa.array(kept, pa.binary()).cast(pa.string()), pa.array(had, pa.int32()), pa.array(gone, pa.int32())]
        return pa.StructArray.from_arrays(arrays, ["text", "n_sentences", "n_removed"])

    return cleaned(text, spans)


def without_repeated_spans(
    docs: DataFrame, least_sentences: int = LEAST_SENTENCES, least_words: int = LEAST_WORDS
) -> DataFrame:
    """``(row, clean)`` of every row: its columns as a struct, and ``clean(text, n_sentences, n_removed)``.

    Sentences that a non-first repeated run covers are gone from ``clean.text``; what is left is
    unchanged. Rows with equal id and text are one document. Null texts count as empty and have nothing
    to remove; rows without an id come last in the order of first places and are told apart by their
    text; a text with fewer sentences or words than a run stays; an empty table gives no rows. Names of
    other columns do not matter.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    boxed = docs.select(row.alias("row"), *_identity())
    joined = boxed.join(repeated_sentences(docs, least_sentences, least_words), ["id", "version"], "left")
    return joined.select("row", _cleaned(F.col("row").getField("text"), F.col("spans")).alias("clean"))
