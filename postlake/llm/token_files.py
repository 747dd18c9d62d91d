"""Token ids as Parquet list columns, in document order, for selective reads."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postlake.llm.common import batch_slices, totals_before
from postlake.llm.tokens import encode_column

END_ID = 1
_META = ("part", "doc_id", "start_in_part", "n_tokens")


def _layout(encoding: str, row_group_bytes: int, page_rows: int) -> dict[str, str]:
    """Writer settings. Version 2 pages delta-code what has no dictionary, which is all but, on wish, the ids;
    column and offset indexes are always written, one entry a page."""
    if encoding not in ("dictionary", "delta"):
        raise ValueError("encoding is 'dictionary' or 'delta'")
    return {
        "parquet.writer.version": "v2",
        "parquet.enable.dictionary": "false",
        "parquet.enable.dictionary#ids.list.element": str(encoding == "dictionary").lower(),
        "parquet.block.size": str(row_group_bytes),
        "parquet.page.row.count.limit": str(page_rows),
    }


def write_tokens(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    end_id: int = END_ID,
    encoding: str = "dictionary",
    row_group_bytes: int = 32 << 20,
    page_rows: int = 1000,
) -> None:
    """Files of ``(part, doc_id, start_in_part, n_tokens, ids)`` in ascending ``doc_id`` order.

    Texts are range-partitioned by id and encoded in order, so a part covers a range of ids, its row
    groups and pages cover narrower ones, and their indexes let a reader skip the rest. ``start_in_part``
    counts the ids of earlier rows of the part. A null text is empty, a null id goes first, repeated ids
    are ordered by text, repeated rows are written again, other columns are ignored, and an empty table
    writes no rows.
    """

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, start = TaskContext.get().partitionId(), 0
        for batch in batch_slices(batches, "text"):
            ids, sizes = encode_column(batch.column("text"), tokenizer, end_id)
            ends = np.cumsum(sizes)
            lists = pa.ListArray.from_arrays(pa.array(np.append(0, ends).astype(np.int32)), pa.array(ids))
            columns = [
                pa.array(np.full(len(sizes), part, np.int32)), batch.column("doc_id"),
                pa.array(start + ends - sizes), pa.array(sizes), lists,
            ]
            yield pa.RecordBatch.from_arrays(columns, [*_META, "ids"])
            start += int(sizes.sum())

    kind = dict(docs.dtypes)["doc_id"]
    ranged = docs.select("doc_id", "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    schema = f"part int, doc_id {kind}, start_in_part bigint, n_tokens bigint, ids array<int>"
    writer = ranged.mapInArrow(encoded, schema).write
    writer.options(**_layout(encoding, row_group_bytes, page_rows)).parquet(path)


def read_tokens(
    spark: SparkSession, path: str, columns: tuple[str, ...] = ("ids",), where: Column | None = None
) -> DataFrame:
    """``(doc_id, start, n_tokens, …)`` of written files; ``start`` counts the ids of all documents before.

    Only the named columns are read besides the metadata. ``where`` filters on ``doc_id`` or
    ``n_tokens`` and skips row groups and pages. What goes out to all tasks is one row of two numbers per
    part, and there are no more parts than partitions of the shuffle that wrote them.
    """
    files = spark.read.parquet(path)
    parts = totals_before(files.groupBy("part").agg(F.sum("n_tokens").alias("_ids")), "part", "_ids", "_before")
    rows = files.select(*_META, *columns)
    if where is not None:
        rows = rows.filter(where)
    return rows.join(F.broadcast(parts), "part").select(
        "doc_id", (F.col("_before") + F.col("start_in_part")).alias("start"), "n_tokens", *columns
    )
