"""Helpers that several operators share: stored tables, whole groups in a stream, split buckets."""

from __future__ import annotations

import os
from collections.abc import Iterator, Sequence
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from postlake.session import shared_folder


_BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
_MOST_BATCH_ROWS = 1000
_LEAST_ROWS = 8192
_FRUGAL = {"ARROW_DEFAULT_MEMORY_POOL": "system", "MALLOC_ARENA_MAX": "2", "MALLOC_TRIM_THRESHOLD_": "131072"}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    importable_by_workers(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stored(frame: DataFrame, purpose: str) -> DataFrame:
    """The frame written to the shared folder and read back: computed once, and safe from lost executors."""
    path = shared_folder(frame.sparkSession, purpose)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def text_slices(texts: pa.Array, most_bytes: int) -> Iterator[pa.Array]:
    """Consecutive slices of a binary column with some ``most_bytes`` each, or one longer text."""
    sizes = texts.fill_null(b"")
    ends = np.cumsum(pc.binary_length(sizes).to_numpy(zero_copy_only=False).astype(np.int64))
    begin = 0
    while begin < len(texts):
        done = ends[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(ends, done + most_bytes, side="right")))
        yield texts.slice(begin, end - begin)
        begin = end


def batch_slices(batches: Iterator[pa.RecordBatch], column: str, most_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in batches with some ``most_bytes`` of ``column`` each."""
    for batch in batches:
        begin = 0
        for some in text_slices(batch.column(column).cast(pa.binary()), most_bytes):
            yield batch.slice(begin, len(some))
            begin += len(some)


def whole_groups(batches: Iterator[pa.RecordBatch], keys: Sequence[str]) -> Iterator[pa.Table]:
    """Cut a stream that is sorted by non-null ``keys`` anew, so that no group is split and tables are not small."""
    held: list[pa.RecordBatch] = []
    held_rows = 0
    for batch in batches:
        rows = batch.num_rows
        if not rows:
            continue
        same = np.ones(rows, bool)
        for key in keys:
            values = batch.column(key).to_numpy(zero_copy_only=False)
            same &= values == values[-1]
        start = rows - int(same.sum())
        if start and held_rows + start >= _LEAST_ROWS:
            yield pa.Table.from_batches([*held, batch.slice(0, start)])
            held, held_rows, batch = [], 0, batch.slice(start)
        held.append(batch)
        held_rows += batch.num_rows
    if held:
        yield pa.Table.from_batches(held)


def group_bounds(table: pa.Table, keys: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """First row of every group of a sorted table, and the row after its last."""
    change = np.zeros(table.num_rows, bool)
    change[:1] = True
    for key in keys:
        values = table.column(key).to_numpy()
        change[1:] |= values[1:] != values[:-1]
    first = np.flatnonzero(change)
    return first, np.append(first[1:], table.num_rows)


def split_buckets(rows: DataFrame, bucket: str, member: str, most: int) -> DataFrame:
    """Add ``part``, ``low`` and ``high``, so that no ``(bucket, low, high)`` holds more than some ``2 * most`` rows.

    A bucket of more than ``most`` rows falls into parts by a hash of ``member``, and each row goes to
    every pair of parts with its own part in it. Two rows of different parts meet in one pair exactly,
    two rows of one part where ``low = high``. Other buckets are one part.
    """
    sizes = rows.groupBy(bucket).agg(F.count("*").alias("_rows")).filter(F.col("_rows") > most)
    parts = sizes.select(bucket, F.ceil(F.col("_rows") / most).alias("_parts"))
    joined = rows.join(parts, bucket, "left").withColumn("_parts", F.coalesce("_parts", F.lit(1)))
    joined = joined.withColumn("part", F.pmod(F.xxhash64(member), "_parts"))
    joined = joined.withColumn("_other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_parts") - 1)))
    return joined.withColumns(
        {"low": F.least("part", "_other"), "high": F.greatest("part", "_other")}
    ).drop("_parts", "_other")


def merge_labels(label: np.ndarray, left: np.ndarray, right: np.ndarray) -> None:
    """Join the sets of ``left`` and ``right`` in ``label``, which holds each item's smallest companion."""
    while True:
        a, b = label[left], label[right]
        open_ = a != b
        if not open_.any():
            return
        left, right, a, b = left[open_], right[open_], a[open_], b[open_]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while True:
            further = label[label]
            if np.array_equal(further, label):
                break
            label[:] = further


def list_matrix(column: pa.ChunkedArray | pa.Array, width: int, dtype) -> np.ndarray:
    """A list column whose lists all have ``width`` elements as a matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(dtype, copy=False).reshape(-1, width)


def totals_before(rows: DataFrame, key: str, value: str, name: str) -> DataFrame:
    """``(key, name)``: the sum of ``value`` over the rows with a smaller whole-number ``key``.

    Sums run inside stretches of a thousand keys and once more over the stretches.
    """
    stretch = rows.withColumn("_stretch", F.floor(F.col(key) / 1024))
    inside = Window.partitionBy("_stretch").orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
    over = Window.orderBy("_stretch").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("bigint")
    summed = stretch.groupBy("_stretch").agg(F.sum(value).alias("_sum"))
    earlier = summed.select("_stretch", F.coalesce(F.sum("_sum").over(over), zero).alias("_earlier"))
    placed = stretch.withColumn("_inside", F.coalesce(F.sum(value).over(inside), zero))
    return placed.join(earlier, "_stretch").select(key, (F.col("_earlier") + F.col("_inside")).alias(name))


def importable_by_workers(spark: SparkSession) -> None:
    """Let Python workers of this machine find the package, and keep them small.

    On a cluster the package is installed or shipped with the job. Batches of texts have some hundred rows,
    and workers, which live for many tasks, give freed memory back.
    """
    root = str(Path(__file__).resolve().parents[2])
    env = spark.sparkContext.environment
    paths = env.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])
    env.update(_FRUGAL)
    if int(spark.conf.get(_BATCH_ROWS)) > _MOST_BATCH_ROWS:
        spark.conf.set(_BATCH_ROWS, str(_MOST_BATCH_ROWS))
