"""SimHash fingerprints and near duplicates by bit-sliced Hamming comparison."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations
from math import log2

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postlake.llm.common import (
    batch_slices,
    group_bounds,
    list_matrix,
    merge_labels,
    split_buckets,
    stored,
    whole_groups,
)
from postlake.llm.components import connected_components
from postlake.llm.manifest import digest_of

SEED = 42
_LANES = np.uint64(0x0101010101010101)
_PAIRS_AT_ONCE = 1 << 16
_PLANES_BETWEEN_CHECKS = 12
_BUCKET_ROWS = 4096
_WEYL = 0x9E3779B97F4A7C15


def shingle_hashes(text: bytes, words: int) -> np.ndarray:
    """XXH64 of every run of ``words`` words, repeats included; a shorter text is one run, an empty one none."""
    found = text.lower().split()
    if not found:
        return np.empty(0, np.uint64)
    joined = b" ".join(found)
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    runs = max(1, len(found) - words + 1)
    digest = xxhash.xxh64_intdigest
    spans = zip(starts[:runs].tolist(), ends[min(words, len(found)) - 1 :].tolist(), strict=True)
    return np.fromiter((digest(joined[a:b], SEED) for a, b in spans), np.uint64, runs)


def _mixed(hashes: np.ndarray, word: int) -> np.ndarray:
    """Further 64 bits of each hash; the first word is the hash itself."""
    if not word:
        return hashes
    x = hashes + np.uint64(_WEYL * word % (1 << 64))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def majority_bits(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """One 64-bit word per text: the bits set in over half of its ``counts`` consecutive hashes.

    Eight shifted copies of a hash keep one bit in each byte; the bytes of up to 255 such words add up
    without overflow, so a sum counts eight bits at a time.
    """
    out = np.zeros(len(counts), np.uint64)
    full = counts > 0
    if not full.any():
        return out
    sizes = counts[full]
    pieces = -(-sizes // 255)
    first_piece = np.cumsum(pieces) - pieces
    inside = np.arange(pieces.sum()) - np.repeat(first_piece, pieces)
    starts = np.repeat(np.cumsum(sizes) - sizes, pieces) + inside * 255
    bits = np.empty((len(sizes), 8, 8), bool)
    for lane in range(8):
        summed = np.add.reduceat((hashes >> np.uint64(lane)) & _LANES, starts)
        per_byte = np.add.reduceat(summed.view(np.uint8).reshape(-1, 8).astype(np.int64), first_piece, axis=0)
        bits[:, :, lane] = per_byte * 2 > sizes[:, None]
    out[full] = np.packbits(bits.reshape(len(sizes), 64), axis=1, bitorder="little").view(np.uint64).ravel()
    return out


def fingerprints(docs: DataFrame, words: int = 3, width: int = 1) -> DataFrame:
    """``(doc_id, fingerprint)`` with ``width`` 64-bit words for every row; a null text counts as empty."""

    def computed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batch_slices(batches, "text"):
            texts = batch.column("text").cast(pa.binary())
            parts = [shingle_hashes(t.as_py() or b"", words) for t in texts]
            counts = np.fromiter(map(len, parts), np.int64, len(parts))
            hashes = np.concatenate([*parts, np.empty(0, np.uint64)])
            prints = np.stack([majority_bits(_mixed(hashes, w), counts) for w in range(width)], axis=1)
            offsets = pa.array(np.arange(0, prints.size + 1, width, dtype=np.int32))
            lists = pa.ListArray.from_arrays(offsets, pa.array(prints.view(np.int64).ravel()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), lists], ["doc_id", "fingerprint"])

    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", "text").mapInArrow(computed, f"doc_id {kind}, fingerprint array<bigint>")


def exact_masks(rows: int, bits: int, radius: int) -> list[int]:
    """Masks such that two fingerprints within ``radius`` agree under one of them.

    The bits fall into blocks; ``radius`` differences leave all but ``radius`` blocks equal. More rows
    take more and smaller blocks, so that the bits of a mask grow with the logarithm of the rows. Any
    choice finds the same pairs.
    """
    wanted = log2(max(rows, 2)) - 6
    blocks = next((b for b in range(radius + 1, bits) if bits * (b - radius) / b >= wanted), bits)
    edges = [bits * i // blocks for i in range(blocks + 1)]
    block = [((1 << edges[i + 1]) - 1) ^ ((1 << edges[i]) - 1) for i in range(blocks)]
    return [sum(block[i] for i in chosen) for chosen in combinations(range(blocks), blocks - radius)]


def _bucket(masks: list[int], width: int) -> Column:
    """The bucket of a fingerprint under every mask."""
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    word = lambda mask, w: F.lit(signed((mask >> (64 * w)) & ((1 << 64) - 1)))
    keys = [
        F.xxhash64(F.lit(i), *[F.get("fingerprint", F.lit(w)).bitwiseAND(word(mask, w)) for w in range(width)])
        for i, mask in enumerate(masks)
    ]
    return F.explode(F.array(*keys))


def close_pairs(
    codes: np.ndarray, ends: np.ndarray, radius: int, take: Callable[[np.ndarray, np.ndarray], None]
) -> None:
    """Give ``take`` the pairs ``i < j < ends[i]`` of rows of ``codes`` that differ in at most ``radius`` bits.

    Blocks of 64 rows are stored as bit planes: plane ``p`` has bit ``p`` of all 64 rows in one word. A
    row is compared with a block by XOR, plane by plane; three planes go through a carry-save adder into
    counters of one bit per row, which start so that they overflow beyond the radius. A block of which
    all rows have overflowed is abandoned.
    """
    rows, bits = len(codes), codes.shape[1] * 64
    padded = -(-rows // 64) * 64
    spread = np.unpackbits(codes.view(np.uint8), axis=1, bitorder="little")
    turned = np.zeros((bits, padded), np.uint8)
    turned[:, :rows] = spread.T
    planes = np.packbits(turned, axis=1, bitorder="little").view(np.uint64)
    turned = turned[:, :rows]
    levels = max(1, int(radius).bit_length())
    start = (1 << levels) - 1 - radius
    asked = np.flatnonzero(ends > np.arange(rows) + 1)
    blocks = (ends[asked] - 1) // 64 - asked // 64 + 1
    cuts = np.searchsorted(np.cumsum(blocks), np.arange(_PAIRS_AT_ONCE, blocks.sum() + _PAIRS_AT_ONCE, _PAIRS_AT_ONCE))
    begin = 0
    for cut in np.unique(np.append(cuts + 1, len(asked))):
        who, many = asked[begin:cut], blocks[begin:cut]
        begin = cut
        if not len(who):
            continue
        query = np.repeat(who, many)
        block = query // 64 + np.arange(len(query)) - np.repeat(np.cumsum(many) - many, many)
        over = ~(_ones_below(ends[query] - 64 * block) & ~_ones_below(query + 1 - 64 * block))
        counters = [np.full(len(query), ~np.uint64(0) if start >> k & 1 else np.uint64(0)) for k in range(levels)]

        def add(value: np.ndarray, level: int) -> None:
            for k in range(level, levels):
                carry = counters[k] & value
                counters[k] ^= value
                value = carry
            np.bitwise_or(over, value, out=over)

        def differ(plane: int) -> np.ndarray:
            inverted = np.negative(turned[plane][query].astype(np.int64)).view(np.uint64)
            return planes[plane][block] ^ inverted

        for plane in range(0, bits, 3):
            if plane + 3 <= bits:
                x, y, z = differ(plane), differ(plane + 1), differ(plane + 2)
                half = x ^ y
                add(half ^ z, 0)
                add((x & y) | (half & z), 1)
            else:
                for rest in range(plane, bits):
                    add(differ(rest), 0)
            if plane % _PLANES_BETWEEN_CHECKS == 0 and plane:
                alive = np.flatnonzero(~over)
                if len(alive) * 4 < len(over) * 3:
                    query, block, over = query[alive], block[alive], over[alive]
                    counters[:] = [c[alive] for c in counters]
                if not len(query):
                    break
        hit, bit = np.nonzero(np.unpackbits((~over).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"))
        take(query[hit], block[hit] * 64 + bit)


def _ones_below(count: np.ndarray) -> np.ndarray:
    """Words with the lowest ``count`` bits set, for counts cut to 0..64."""
    count = np.clip(count, 0, 64).astype(np.uint64)
    return np.where(count == 64, ~np.uint64(0), (np.uint64(1) << (count & np.uint64(63))) - np.uint64(1))


def _links(batches: Iterator[pa.RecordBatch], width: int, radius: int) -> Iterator[pa.RecordBatch]:
    keys = ["bucket", "low", "high"]
    for table in whole_groups(batches, keys):
        first, last = group_bounds(table, keys)
        sizes = last - first
        if sizes.max() < 2:
            continue
        wide = np.repeat(sizes > 1, sizes)
        table = table.filter(pa.array(wide))
        sizes = sizes[sizes > 1]
        ends = np.repeat(np.cumsum(sizes), sizes)
        node, part = table.column("node").to_numpy(), table.column("part").to_numpy()
        across = (table.column("low").to_numpy() != table.column("high").to_numpy())
        codes = np.ascontiguousarray(list_matrix(table.column("fingerprint"), width, np.int64)).view(np.uint64)
        label = np.arange(len(node))

        def take(i: np.ndarray, j: np.ndarray) -> None:
            counted = ~across[i] | (part[i] != part[j])
            merge_labels(label, i[counted], j[counted])

        close_pairs(codes, ends, radius, take)
        linked = np.flatnonzero(label != np.arange(len(node)))
        yield pa.RecordBatch.from_arrays([pa.array(node[linked]), pa.array(node[label[linked]])], ["a", "b"])


def near_duplicates(docs: DataFrame, words: int = 3, radius: int = 3, width: int = 1) -> DataFrame:
    """``(doc_id, fingerprint, component_id)`` for every row of ``docs(doc_id, text, …)``.

    Fingerprints of ``64 * width`` bits link when they differ in at most ``radius`` bits, and all such
    links are found. ``component_id`` is the smallest ``doc_id`` reachable.

    Texts are compared once per fingerprint, however many rows have it. Buckets are split into pairs of
    parts beyond a few thousand fingerprints, and a task gives one link per fingerprint at most, so
    groups of copies neither meet in one task nor grow by pairs. A null or empty text has fingerprint
    zero; a null id is never the smallest, and a component without any id has a null one; repeated rows
    are given again; other columns are ignored; an empty table gives no rows.
    """
    prints = stored(fingerprints(docs, words, width), "fingerprints")
    distinct = prints.groupBy("fingerprint").agg(F.min("doc_id").alias("first_id"))
    nodes = stored(distinct.withColumn("node", F.monotonically_increasing_id()), "distinct")
    masks = exact_masks(nodes.count(), 64 * width, radius)
    buckets = nodes.select("node", "fingerprint", _bucket(masks, width).alias("bucket"))
    placed = split_buckets(buckets, "bucket", "node", _BUCKET_ROWS)
    sorted_ = placed.repartition("bucket", "low", "high").sortWithinPartitions("bucket", "low", "high")
    links = sorted_.select("bucket", "low", "high", "part", "node", "fingerprint").mapInArrow(
        lambda batches: _links(batches, width, radius), "a bigint, b bigint"
    )
    return _labelled(prints, nodes, ["fingerprint"], links).select("doc_id", "fingerprint", "component_id")


def _labelled(rows: DataFrame, nodes: DataFrame, keys: list[str], links: DataFrame) -> DataFrame:
    """``rows`` with the smallest id that the links of their nodes reach; a node is known by ``keys``."""
    members = connected_components(links)
    first = F.min("first_id").alias("component_id")
    smallest = members.join(nodes.select("node", "first_id"), "node").groupBy("component").agg(first)
    linked = members.join(smallest, "component").select("node", "component_id")
    classes = nodes.join(linked, "node", "left").select(
        *keys, F.coalesce("component_id", "first_id").alias("component_id")
    )
    return rows.join(classes, keys)


def without_near_duplicates(docs: DataFrame, words: int = 3, radius: int = 3) -> DataFrame:
    """One row of every group that :func:`near_duplicates` links, with the columns of ``docs``.

    It is the row with the smallest ``doc_id``, one with an id if there is any, and of rows that share it the
    one whose text has the smallest hash. Rows are told apart by id and text, so rows with the same id
    and other texts stand for themselves. Of repeated rows one stays, whichever columns differ besides. They are
    cut to one in each input partition first; then ``docs`` is shuffled once, whatever the number of rows that go.
    """
    key = digest_of([F.col("doc_id"), F.col("text")])
    place = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", key.alias("key"))
    found = near_duplicates(docs.select(place.alias("doc_id"), "text"), words, radius)
    gone = found.filter(F.col("doc_id") != F.col("component_id")).select(F.col("doc_id.key").alias("_key"))
    gone = stored(gone.distinct(), "copies")
    keyed = docs.select(F.struct("*").alias("row"), key.alias("_key"))
    nth = F.row_number().over(Window.partitionBy("_key").orderBy("_key"))
    single = keyed.withColumn("_nth", nth).filter("_nth = 1")
    return single.join(gone.hint("merge"), "_key", "left_anti").select("row.*")


def hexadecimal(fingerprint: Column) -> Column:
    """16 hex digits for each word."""
    return F.array_join(F.transform(fingerprint, lambda w: F.lower(F.lpad(F.hex(w), 16, "0"))), "")
