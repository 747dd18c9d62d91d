"""Shuffled shards by a two-pass external shuffle."""

from __future__ import annotations

from math import ceil

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlake.llm.common import totals_before
from postlake.session import shared_folder

SEED = 42
SHARDS = 8
BUCKET_BYTES = 16 << 20


def fisher_yates(rows: int, seed: int, bucket: int) -> np.ndarray:
    """A seeded permutation of ``rows`` places."""
    order = list(range(rows))
    draws = np.random.default_rng([seed, bucket]).integers(0, np.arange(rows, 1, -1)) if rows > 1 else []
    for last, other in zip(range(rows - 1, 0, -1), draws, strict=True):
        order[last], order[other] = order[other], order[last]
    return np.array(order, np.int64)


def _bucket(buckets: int, seed: int) -> Column:
    """Uniform over the distinct pairs of id and text, so that an id that is repeated with many texts scatters."""
    return F.pmod(F.xxhash64(F.lit(seed), "doc_id", "text"), F.lit(buckets))


def write_shards(
    docs: DataFrame, path: str, shards: int = SHARDS, seed: int = SEED, bucket_bytes: int = BUCKET_BYTES
) -> None:
    """All rows of ``docs``, whole and shuffled, in folders ``shard=0`` to ``shard=<shards - 1>``.

    A file row is ``(slot, row)`` with ``row`` the struct of the document's columns, so no name clashes.
    First pass: rows scatter into buckets of some ``bucket_bytes`` by a seeded hash of id and text. Second
    pass: each bucket is put in a canonical order, shuffled by Fisher-Yates with a seed of its own, and
    written. Buckets follow each other, and shard ``s`` takes the rows from ``s * n / shards`` on, so
    counts differ by one at most (law ``rows``); slots are gapless from 0. The same seed and rows give
    the same shards. Rows without an id, or with one that many rows share, scatter by their text; rows equal in
    both meet in one bucket. Null and empty texts take part, equal
    texts and repeated rows are rows like others, and an empty table writes no rows.
    """
    size = F.coalesce(F.octet_length("text"), F.lit(0)) + 1
    total, rows = docs.agg(F.coalesce(F.sum(size), F.lit(0)), F.count("*")).first()
    buckets = max(1, ceil(total / bucket_bytes))
    placed = docs.select(
        _bucket(buckets, seed).alias("bucket"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    )
    counts = docs.groupBy(_bucket(buckets, seed).alias("bucket")).agg(F.count("*").alias("_rows"))
    starts = totals_before(counts, "bucket", "_rows", "first")

    def shuffled(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        row = group.column("row").combine_chunks()
        named = pa.table({"id": pc.struct_field(row, "doc_id"), "text": pc.struct_field(row, "text")})
        canonical = pc.sort_indices(named, [("id", "ascending"), ("text", "ascending")])
        mixed = canonical.take(pa.array(fisher_yates(len(row), seed, key[0].as_py())))
        first = group.column("first")[0].as_py()
        place = pa.array(first + np.arange(len(row)))
        return pa.table({"place": place, "row": row.take(mixed)})

    joined = placed.join(starts, "bucket")
    kind = placed.schema["row"].dataType.simpleString()
    mixed = joined.groupBy("bucket").applyInArrow(shuffled, f"place bigint, row {kind}")
    # Shard s holds the places p with s = (p * shards + shards - 1) div n.
    shard = F.expr(f"((place + 1) * {shards} - 1) div {max(rows, 1)}").cast("int")
    first_place = F.expr(f"(shard * {rows}L) div {shards}")
    out = mixed.withColumn("shard", shard).withColumn("slot", F.col("place") - first_place)
    out.select("slot", "row", "shard").write.partitionBy("shard").parquet(path)


def sharded(docs: DataFrame, shards: int = SHARDS, seed: int = SEED, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """``(shard, slot, row)`` read back from shards written to the shared folder."""
    path = shared_folder(docs.sparkSession, "shards")
    write_shards(docs, path, shards, seed, bucket_bytes)
    kind = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    schema = docs.select(F.lit(0).cast("bigint").alias("slot"), kind.alias("row"), F.lit(0).alias("shard")).schema
    return docs.sparkSession.read.schema(schema).parquet(path)
