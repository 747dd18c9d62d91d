"""A positional inverted index of texts, and phrases of other texts found in it.

Texts are indexed in segments of consecutive rows. A segment has the positions of each of its terms, texts
one after another with a gap between them that no phrase spans. Phrases are looked up from their
rarest term on: its positions, moved back by its place in the phrase, are where the phrase may begin, and
each further list, moved likewise, leaves those that it also has.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlake.llm.common import batch_slices, stored
from postlake.session import shared_folder

PHRASE_WORDS, SLACK = 10, 2
GAP = 64
_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# The same on UTF-8 bytes: all bytes beyond ASCII belong to words.
_WORD_BYTES = re.compile(rb"[0-9a-z\x80-\xff]+")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_SEGMENT_WORDS, _SEGMENT_ROWS = 2_000_000, 65_536
_PHRASES_AT_ONCE, _PLACES_AT_ONCE = 1 << 17, 1 << 20
_STARTS = -1
# Positions ascend, so version 2 pages store the small differences.
_LAYOUT = {
    "parquet.writer.version": "v2",
    "parquet.enable.dictionary#positions.list.element": "false",
    "parquet.enable.dictionary#ids.list.element": "false",
}


class _Segment:
    """Words of consecutive rows, until there are enough of them."""

    def __init__(self) -> None:
        self.words: list[pa.Array] = []
        self.sizes: list[int] = []
        self.ids: list[pa.Array] = []
        self.total = 0

    def add(self, ids: pa.Array, texts: pa.Array) -> None:
        found = [_WORD_BYTES.findall((t.as_py() or b"").lower()) for t in texts]
        self.words.append(pa.array([w for words in found for w in words], pa.binary()))
        self.sizes += map(len, found)
        self.ids.append(ids)
        self.total += len(self.words[-1])

    def full(self, words: int) -> bool:
        return self.total >= words or len(self.sizes) >= _SEGMENT_ROWS

    def rows(self, number: int) -> pa.RecordBatch:
        """A row per term, and one with the ids of the texts and where they start."""
        coded = pa.chunked_array(self.words, pa.binary()).dictionary_encode().combine_chunks()
        if isinstance(coded, pa.ChunkedArray):
            coded = pa.DictionaryArray.from_arrays(pa.array([], pa.int32()), pa.array([], pa.binary()))
        sizes = np.array(self.sizes, np.int64)
        starts = GAP + np.append(0, np.cumsum(sizes + GAP))
        codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        places = np.arange(self.total) + np.repeat(starts[:-1] - (np.cumsum(sizes) - sizes), sizes)
        order = np.sort((codes << 32) | places)
        counts = np.bincount(codes, minlength=len(coded.dictionary))
        ends = np.cumsum([0, *counts.tolist(), len(starts)])
        positions = np.concatenate([order & 0xFFFFFFFF, starts]).astype(np.int32)
        ids = pa.concat_arrays(self.ids)
        many = len(counts) + 1
        columns = [
            pa.array(np.full(many, number)),
            pa.concat_arrays([coded.dictionary.cast(pa.string()), pa.nulls(1, pa.string())]),
            pa.array(np.append(counts, len(sizes))),
            pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(positions)),
            pa.ListArray.from_arrays(pa.array([0] * many + [len(ids)], pa.int32()), ids),
        ]
        return pa.RecordBatch.from_arrays(columns, ["segment", "term", "n", "positions", "ids"])


def build_index(docs: DataFrame, segment_words: int = _SEGMENT_WORDS) -> DataFrame:
    """The stored index of ``docs(doc_id, text, …)``: ``(segment, term, n, positions, ids)``.

    A row per term of a segment with its ``n`` positions, and one without a term whose ``ids`` are the
    segment's documents and ``positions`` their starts, the last one that of what would come next. Every
    term of every text is indexed, texts are whole, and nothing is shuffled. Terms are runs of ASCII
    digits and letters, lower-cased, and of all characters beyond ASCII. A segment has some
    ``segment_words``, or one longer text. A null text has no terms; null
    and repeated ids are documents like others; other columns are ignored.
    """

    def indexed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, segment = TaskContext.get().partitionId() << 32, _Segment()
        for batch in batch_slices(batches, "text"):
            segment.add(batch.column("doc_id"), batch.column("text").cast(pa.binary()))
            if segment.full(segment_words):
                yield segment.rows(number)
                number, segment = number + 1, _Segment()
        if segment.sizes:
            yield segment.rows(number)

    kind = dict(docs.dtypes)["doc_id"]
    made = docs.select("doc_id", "text").mapInArrow(
        indexed, f"segment bigint, term string, n bigint, positions array<int>, ids array<{kind}>"
    )
    path = shared_folder(docs.sparkSession, "phrase-index")
    made.write.options(**_LAYOUT).parquet(path)
    return docs.sparkSession.read.schema(made.schema).parquet(path)


def indexed_documents(index: DataFrame) -> DataFrame:
    """``(segment, place, doc_id, n_words)`` of every document of an index."""
    lists = index.filter(F.col("term").isNull()).select("segment", "positions", F.posexplode("ids").alias("place", "doc_id"))
    words = F.element_at("positions", F.col("place") + 2) - F.element_at("positions", F.col("place") + 1) - GAP
    return lists.select("segment", "place", "doc_id", words.cast("bigint").alias("n_words"))


@dataclass(frozen=True)
class Phrases:
    """Distinct phrases ``(phrase, words)`` and which items have them ``(phrase, item)``; both are stored."""

    words: DataFrame
    items: DataFrame


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(F.translate(text, _UPPER, _LOWER), F.lit(_WORD), F.lit(0))


def phrases_of(items: DataFrame, item: str = "item_id", text: str = "text", width: int = PHRASE_WORDS) -> Phrases:
    """Every run of ``width`` consecutive words of every item; an item of fewer, but not none, is one phrase.

    Items are known by their id as a string; one without an id reads ``null``, and rows that share an id
    are one item.
    """
    if width + SLACK >= GAP:
        raise ValueError("a phrase must be shorter than the gap between texts")
    named = items.select(F.coalesce(F.col(item).cast("string"), F.lit("null")).alias("item"), words_of(F.col(text)).alias("_words"))
    last = F.greatest(F.size("_words") - width, F.lit(0))
    runs = F.transform(F.sequence(F.lit(0), last), lambda i: F.slice("_words", i + 1, F.lit(width)))
    cut = stored(named.filter(F.size("_words") > 0).select("item", F.explode(runs).alias("words")).distinct(), "item-phrases")
    numbered = stored(cut.select("words").distinct().withColumn("phrase", F.monotonically_increasing_id()), "phrases")
    return Phrases(numbered, stored(cut.join(numbered, "words").select("phrase", "item"), "phrase-items"))


def _asked(index: DataFrame, phrases: Phrases) -> tuple[DataFrame, DataFrame]:
    """``(term, term_id)`` of the phrases' terms in the index, and ``(phrase, n, terms, places)``, rarest terms first.

    Phrases with a term that the index lacks are left out, for they occur nowhere.
    """
    placed = phrases.words.select("phrase", F.size("words").alias("n"), F.posexplode("words").alias("place", "term"))
    wanted = stored(placed.select("term").distinct(), "wanted-terms")
    found = index.filter(F.col("term").isNotNull()).select("term", "n").join(wanted, "term", "left_semi")
    counted = found.groupBy("term").agg(F.sum("n").alias("total"))
    terms = stored(counted.withColumn("term_id", F.monotonically_increasing_id()), "terms")
    known = placed.join(terms, "term").groupBy("phrase", "n").agg(
        F.array_sort(F.collect_list(F.struct("total", "term", "place", "term_id"))).alias("_by_rarity")
    )
    ordered = known.filter(F.size("_by_rarity") == F.col("n")).select(
        "phrase", "n", F.col("_by_rarity.term_id").alias("terms"), F.col("_by_rarity.place").alias("places")
    )
    return terms.select("term", "term_id"), stored(ordered, "asked-phrases")


def _matrix(column: pa.ChunkedArray, width: int, fill: int) -> np.ndarray:
    """Lists as rows of a matrix, shorter ones filled up."""
    lists = column.combine_chunks()
    sizes = lists.value_lengths().to_numpy()
    out = np.full((len(sizes), width), fill, np.int64)
    out[np.arange(width) < sizes[:, None]] = lists.flatten().to_numpy()
    return out


class _Lists:
    """The position lists of a segment as one ascending array, each list in a stretch of numbers of its own."""

    def __init__(self, term_ids: np.ndarray, lists: list[np.ndarray], last: int) -> None:
        order = np.argsort(term_ids)
        self.ids, self.stretch = term_ids[order], last + 2 * GAP
        sizes = np.array([len(lists[i]) for i in order], np.int64)
        self.ends = np.append(0, np.cumsum(sizes))
        flat = np.concatenate([lists[i] for i in order]) if len(order) else np.empty(0, np.int64)
        self.keys = flat.astype(np.int64) + np.repeat(np.arange(len(order)) * self.stretch, sizes)

    def rows_of(self, term_ids: np.ndarray) -> np.ndarray:
        """Which list each term has, or -1."""
        at = np.minimum(np.searchsorted(self.ids, term_ids), max(0, len(self.ids) - 1))
        return np.where(self.ids[at] == term_ids, at, -1) if len(self.ids) else np.full(term_ids.shape, -1)

    def within(self, row: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Whether a list has a position from ``low`` to ``high``."""
        base = row * self.stretch
        at = np.searchsorted(self.keys, base + low)
        return (at < len(self.keys)) & (self.keys[np.minimum(at, len(self.keys) - 1)] <= base + high)


def _places(
    lists: _Lists, rows: np.ndarray, offsets: np.ndarray, sizes: np.ndarray, slack: int
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``(phrase, start, exact)`` of all phrases, given by their terms' lists, places and numbers of words.

    A phrase is near where each of its terms is at most ``slack`` places away from its place relative to
    the rarest term, and exact where none is.
    """
    there = np.flatnonzero(((rows >= 0) | (np.arange(rows.shape[1]) >= sizes[:, None])).all(axis=1))
    first, last = lists.ends[rows[there, 0]], lists.ends[rows[there, 0] + 1]
    upto = np.cumsum(last - first)
    begin = 0
    while begin < len(there):
        done = upto[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(upto, done + _PLACES_AT_ONCE, side="right")))
        many = (last - first)[begin:end]
        phrase = np.repeat(there[begin:end], many)
        inside = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        found = lists.keys[np.repeat(first[begin:end], many) + inside]
        start = found - rows[phrase, 0] * lists.stretch - offsets[phrase, 0]
        for term in range(1, rows.shape[1]):
            at = start + offsets[phrase, term]
            near = (term >= sizes[phrase]) | lists.within(np.maximum(rows[phrase, term], 0), at - slack, at + slack)
            phrase, start = phrase[near], start[near]
        exact = np.ones(len(phrase), bool)
        for term in range(1, rows.shape[1] if slack else 0):
            at = start + offsets[phrase, term]
            exact &= (term >= sizes[phrase]) | lists.within(np.maximum(rows[phrase, term], 0), at, at)
        yield phrase, start, exact
        begin = end


def find_phrases(index: DataFrame, phrases: Phrases, slack: int = SLACK) -> DataFrame:
    """``(segment, place, phrases, near, runs)``: what every document with a match holds.

    ``phrases`` are those that occur word by word, ``near`` those of which each term is at most ``slack``
    places from where the rarest one says it should be; ``runs`` are the stretches of words, counted in
    the document, that lie inside occurrences. A segment meets the phrases whose rarest term it has, and
    of its lists only those of terms that are asked for are moved. A segment with many phrases takes
    several tasks, some hundred thousand phrases each.
    """
    if slack < 0 or 2 * slack + PHRASE_WORDS >= GAP:
        raise ValueError("slack must not reach into the next text")
    terms, asked = _asked(index, phrases)
    parts = max(1, ceil(asked.count() / _PHRASES_AT_ONCE))
    named = index.filter(F.col("term").isNotNull()).join(terms, "term")
    anchored = named.select("segment", F.col("term_id").alias("_anchor")).join(
        asked.withColumn("_anchor", F.col("terms")[0]), "_anchor"
    )
    looked_up = anchored.select(
        "segment", F.pmod("phrase", F.lit(parts)).alias("part"), "phrase", "n", "terms", "places"
    )
    starts = index.filter(F.col("term").isNull()).select("segment", F.lit(_STARTS).cast("bigint").alias("term_id"), "positions")
    every = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(parts - 1).cast("bigint"))).alias("part")
    own = F.col("segment").alias("segment")  # a column of its own, for both sides come from the index
    lists = named.select("segment", "term_id", "positions").unionByName(starts).select(own, "term_id", "positions", every)

    def intersected(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return _NOTHING
        term_ids = right.column("term_id").to_numpy()
        positions = right.column("positions").combine_chunks()
        flat, ends = positions.flatten().to_numpy(), np.append(0, np.cumsum(positions.value_lengths().to_numpy()))
        each = [flat[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
        own = int(np.flatnonzero(term_ids == _STARTS)[0])
        starts = each.pop(own)
        held = _Lists(np.delete(term_ids, own), each, int(starts[-1]))
        sizes = left.column("n").to_numpy().astype(np.int64)
        width = int(sizes.max())
        rows = held.rows_of(_matrix(left.column("terms"), width, _STARTS))
        offsets = _matrix(left.column("places"), width, 0)
        found = [np.concatenate(x) for x in zip(*_places(held, rows, offsets, sizes, slack), strict=True)]
        if not found or not len(found[0]):
            return _NOTHING
        phrase, start, exact = found
        anchor = start + offsets[phrase, 0]
        place = np.searchsorted(starts, anchor, side="right") - 1
        names = left.column("phrase").to_numpy()[phrase]
        change = np.zeros(int(starts[-1]) + GAP + 1, np.int64)
        np.add.at(change, start[exact], 1)
        np.add.at(change, start[exact] + sizes[phrase[exact]], -1)
        covered = np.flatnonzero(np.diff(np.append(0, np.cumsum(change) > 0)))
        begins, finishes = covered[0::2], covered[1::2]
        of_run = np.searchsorted(starts, begins, side="right") - 1
        docs = np.unique(place)
        runs = pa.StructArray.from_arrays(
            [pa.array((x - starts[of_run]).astype(np.int32)) for x in (begins, finishes)], ["begin", "end"]
        )
        segment = pa.array(np.full(len(docs), right.column("segment")[0].as_py()))
        lists_of = [_listed(docs, *_distinct(place[exact], names[exact])), _listed(docs, *_distinct(place, names))]
        return pa.table(
            [segment, pa.array(docs.astype(np.int32)), *lists_of, _listed(docs, of_run, runs)], _NOTHING.column_names
        )

    both = looked_up.groupBy("segment", "part").cogroup(lists.groupBy("segment", "part"))
    return both.applyInArrow(intersected, _FOUND)


_FOUND = "segment bigint, place int, phrases array<bigint>, near array<bigint>, runs array<struct<begin:int,end:int>>"
_NOTHING = pa.table(
    {
        "segment": pa.array([], pa.int64()),
        "place": pa.array([], pa.int32()),
        "phrases": pa.array([], pa.list_(pa.int64())),
        "near": pa.array([], pa.list_(pa.int64())),
        "runs": pa.array([], pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())]))),
    }
)


def _distinct(place: np.ndarray, names: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """Distinct pairs in ascending order."""
    order = np.lexsort((names, place))
    place, names = place[order], names[order]
    new = np.ones(len(place), bool)
    new[1:] = (place[1:] != place[:-1]) | (names[1:] != names[:-1])
    return place[new], pa.array(names[new], pa.int64())


def _listed(docs: np.ndarray, place: np.ndarray, values: pa.Array) -> pa.Array:
    """Values, whose documents ascend, as one list for each of ``docs``."""
    ends = np.append(np.searchsorted(place, docs), len(place)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), values)


def _words_inside(runs: Column) -> Column:
    """How many words lie in a union of ``(begin, end)`` stretches."""
    seen = F.struct(F.lit(0).cast("bigint").alias("words"), F.lit(0).alias("upto"))

    def more(state: Column, run: Column) -> Column:
        added = F.greatest(run["end"] - F.greatest(run["begin"], state["upto"]), F.lit(0)).cast("bigint")
        return F.struct((state["words"] + added).alias("words"), F.greatest(state["upto"], run["end"]).alias("upto"))

    return F.aggregate(F.array_sort(runs), seen, more)["words"]


def contamination(index: DataFrame, phrases: Phrases, slack: int = SLACK) -> DataFrame:
    """``(doc_id, n_words, n_hit, n_items, items_sha256, contaminated, n_near)`` for every indexed document.

    ``n_hit`` words lie inside occurrences of phrases, ``n_items`` items have such, ``items_sha256`` is the hash
    of their sorted ids, comma-joined, and ``n_near`` further items have phrases that only nearly occur. A
    document without words has zeros. Lists are per document and at most as long as the phrases it holds.
    """
    found = stored(find_phrases(index, phrases, slack), "phrase-matches")
    key = ["segment", "place"]
    hit = found.groupBy(*key).agg(_words_inside(F.flatten(F.collect_list("runs"))).alias("n_hit"))
    flags = found.select(*key, F.explode("near").alias("phrase"), F.col("phrases").alias("_exact"))
    flags = flags.select(*key, "phrase", F.array_contains("_exact", F.col("phrase")).alias("_exact"))
    items = flags.join(phrases.items, "phrase").groupBy(*key, "item").agg(F.max("_exact").alias("_exact"))
    exact = F.when(F.col("_exact"), F.col("item"))
    listed = items.groupBy(*key).agg(
        F.count(exact).alias("n_items"), F.array_sort(F.collect_list(exact)).alias("_items"),
        F.count_if(~F.col("_exact")).alias("n_near"),
    )
    joined = indexed_documents(index).join(hit, key, "left").join(listed, key, "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0).cast("bigint"))
    return joined.select(
        "doc_id", "n_words", zero("n_hit").alias("n_hit"), zero("n_items").alias("n_items"),
        F.sha2(F.coalesce(F.array_join("_items", ","), F.lit("")), 256).alias("items_sha256"),
        (zero("n_hit") > 0).alias("contaminated"), zero("n_near").alias("n_near"),
    )
