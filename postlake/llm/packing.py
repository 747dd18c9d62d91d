"""Packing documents into sequences by vector best-fit."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import ceil

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlake.llm.common import batch_slices, stored
from postlake.llm.tokens import crc_of, encode_column

END_ID = 1
GROUP_PIECES = 16384
_DROP_FULL_EVERY = 64


@dataclass(frozen=True)
class Capacity:
    """What a sequence holds: tokens, pieces, and attention cost (the sum of squared piece lengths).

    ``weights`` say how much each left-over counts when bins are compared; ``rule`` is ``norm`` (the least
    weighted norm of what would be left) or ``dot`` (the least weighted dot product of what is left with
    the piece's demand).
    """

    tokens: int = 4096
    pieces: int = 4096
    attention: int = 4096 * 4096
    weights: tuple[float, float, float] = (1.0, 0.01, 0.01)
    rule: str = "norm"


def best_fit(lengths: np.ndarray, capacity: Capacity) -> tuple[np.ndarray, np.ndarray]:
    """``(bin, offset)`` of every piece, for lengths in descending order and none above the capacity.

    A piece goes to the open bin that it fits under every constraint and that the rule prefers, the
    earliest of equal ones; if none fits it opens a bin.
    """
    most = np.array([capacity.tokens, capacity.pieces, capacity.attention], np.float64)
    scale = np.array(capacity.weights) / most**2
    count = len(lengths)
    bins, offsets = np.empty(count, np.int64), np.empty(count, np.int64)
    left, name = np.empty((3, 0)), np.empty(0, np.int64)
    grown, opened = 0, 0
    for i, length in enumerate(lengths.tolist()):
        need = np.array([length, 1.0, float(length) * length])
        if i % _DROP_FULL_EVERY == 0:
            useful = (left[0, :grown] >= lengths[-1]) & (left[1, :grown] >= 1)
            left, name = left[:, :grown][:, useful], name[:grown][useful]
            grown = len(name)
            left = np.hstack([left, np.zeros((3, _DROP_FULL_EVERY))])
            name = np.append(name, np.zeros(_DROP_FULL_EVERY, np.int64))
        open_ = left[:, :grown]
        fits = (open_[0] >= need[0]) & (open_[1] >= need[1]) & (open_[2] >= need[2])
        places = np.flatnonzero(fits)
        if len(places):
            rest = open_[:, places]
            if capacity.rule == "dot":
                cost = (scale * need) @ rest
            else:
                cost = scale @ (rest - need[:, None]) ** 2
            at = places[int(np.argmin(cost))]
        else:
            at, grown = grown, grown + 1
            left[:, at], name[at] = most, opened
            opened += 1
        bins[i], offsets[i] = name[at], capacity.tokens - int(left[0, at])
        left[:, at] -= need
    return bins, offsets


def pieces(docs: DataFrame, tokenizer: str, longest: int, end_id: int = END_ID, with_ids: bool = True) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32[, ids])``: the ids of every text in pieces of ``longest``."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batch_slices(batches, "text"):
            ids, sizes = encode_column(batch.column("text"), tokenizer, end_id)
            many = -(-sizes // longest)
            row = np.repeat(np.arange(len(sizes)), many)
            piece = np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)
            start = piece * longest
            length = np.minimum(sizes[row] - start, longest)
            ends = np.cumsum(length)
            columns = [
                batch.column("doc_id").take(pa.array(row)), pa.array(piece.astype(np.int32)), pa.array(start),
                pa.array(length), pa.array(crc_of(ids, ends - length, ends), pa.int64()),
            ]
            if with_ids:
                columns.append(pa.ListArray.from_arrays(pa.array(np.append(0, ends).astype(np.int32)), pa.array(ids)))
            yield pa.RecordBatch.from_arrays(columns, names)

    kind = dict(docs.dtypes)["doc_id"]
    schema = f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint"
    names = ["doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else [])]
    schema += ", ids array<int>" if with_ids else ""
    return docs.select("doc_id", "text").mapInArrow(cut, schema)


def pack(
    docs: DataFrame, tokenizer: str, capacity: Capacity | None = None, end_id: int = END_ID, with_ids: bool = True
) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32, sequence_id, offset[, ids])``, one row per piece.

    A text's ids and ``end_id`` make one piece; only longer ones are cut, into pieces that fill a
    sequence and a rest. Pieces are stored first, so a text is encoded once. Full pieces are sequences.
    The others fall at random into groups of some thousands, so that each group has lengths of every
    kind, and every group is packed in descending order of length; a group leaves a part of a sequence
    or two unfilled at most, whatever the number of groups. Only lengths reach the packing, and ids are
    stored only if they are asked for. Since a full piece must fit, the attention limit is at least the
    square of the tokens, which no sequence exceeds; it only counts in the choice of a bin.

    A null text is empty and has the end id alone. Rows with a null or repeated id are documents like
    others; other columns are ignored; an empty table gives no rows.
    """
    capacity = capacity or Capacity()
    if capacity.attention < capacity.tokens**2 or capacity.pieces < 1:
        raise ValueError("a full piece must fit into an empty sequence")
    cut = pieces(docs, tokenizer, capacity.tokens, end_id, with_ids)
    kept = stored(cut.withColumn("_piece_key", F.monotonically_increasing_id()), "pieces")
    short = kept.filter(F.col("length") < capacity.tokens).select("_piece_key", "length")
    groups = max(1, ceil(short.count() / GROUP_PIECES))
    grouped = short.withColumn("_group", F.pmod(F.xxhash64("_piece_key"), F.lit(groups)))

    def packed(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "_piece_key"], ascending=[False, True])
        bins, offsets = best_fit(rows["length"].to_numpy(), capacity)
        return pd.DataFrame(
            {"_piece_key": rows["_piece_key"], "sequence_id": (int(key[0]) << 32) + bins, "offset": offsets}
        )

    placed = grouped.groupBy("_group").applyInPandas(packed, "_piece_key bigint, sequence_id bigint, offset bigint")
    joined = kept.join(placed, "_piece_key", "left")
    alone = -1 - F.col("_piece_key")
    return joined.select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        F.coalesce("sequence_id", alone).alias("sequence_id"),
        F.coalesce("offset", F.lit(0).cast("bigint")).alias("offset"), *(["ids"] if with_ids else []),
    )


def sequences(packed: DataFrame) -> DataFrame:
    """``(sequence_id, n_pieces, ids)``: the packed sequences; their capacity bounds the rows of a group."""
    placed = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(
        F.count("*").alias("n_pieces"), F.flatten(F.transform(placed, lambda p: p["ids"])).alias("ids")
    )
