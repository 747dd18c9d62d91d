"""Fill-in-the-middle: texts cut at two borders of units and put into another order behind marks."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from postlake.llm.common import batch_slices

# A unit is a word with the white space before it, or the white space at the end.
UNIT = r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+"
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED, CHANGED_PERCENT, SUFFIX_FIRST_PERCENT = 42, 50, 80

_FILLED = StructType(
    [
        StructField("n", LongType()),
        StructField("form", StringType()),
        StructField("prefix_chars", LongType()),
        StructField("middle_chars", LongType()),
        StructField("output", StringType()),
    ]
)


def _drawn(seed: int, key: str) -> list[int]:
    """Four 32-bit numbers from the seed and a document's key."""
    digest = hashlib.sha256(f"{seed}:{key}".encode()).hexdigest()
    return [int(digest[i : i + 8], 16) for i in range(0, 32, 8)]


def rearranged(
    units: regex.Pattern, text: str, draws: list[int], changed: int, suffix_first: int
) -> tuple[int, str, int | None, int | None, str]:
    """``(n, form, prefix_chars, middle_chars, output)`` of one text.

    ``units`` repeats one captured unit and matches the whole text; the match keeps every repetition, so
    the ends of its group are the borders of all ``n`` units at once.
    """
    ends = units.fullmatch(text).ends(1)
    n = len(ends)
    if not text or any(m in text for m in (PREFIX, SUFFIX, MIDDLE)) or draws[2] % 100 >= changed:
        return n, "plain", None, None, text
    borders = sorted(d % (n + 1) for d in draws[:2])
    low, high = (ends[b - 1] if b else 0 for b in borders)
    prefix, middle, suffix = text[:low], text[low:high], text[high:]
    if draws[3] % 100 < suffix_first:
        return n, "spm", low, high - low, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    return n, "psm", low, high - low, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"


def fill_in_middle(
    docs: DataFrame,
    seed: int = SEED,
    unit: str = UNIT,
    changed: int = CHANGED_PERCENT,
    suffix_first: int = SUFFIX_FIRST_PERCENT,
) -> DataFrame:
    """``(row, fim)`` for every row of ``docs(doc_id, text, …)``; ``row`` holds its columns.

    ``fim`` is ``(n, form, prefix_chars, middle_chars, output)``: the number of units, ``plain``, ``psm``
    (prefix, suffix, middle) or ``spm`` (suffix, prefix, middle), the code points of prefix and middle
    (null if plain), and the text for training. ``changed`` percent of the texts are put into another
    order, ``suffix_first`` percent of those into ``spm``; the draws depend on seed and ``doc_id`` only.
    Texts that are empty or hold a mark stay plain, so :func:`restored` gives every text back.

    ``unit`` must match some prefix of any non-empty rest of a text. Row-local: nothing is shuffled, and
    texts of any length are matched whole, some MB of them at a time. A null text counts as empty, a null
    id draws as the empty string does, repeated rows are given again, and an empty table gives no rows.
    """
    # Units are cut from left to right and never given back, so a match keeps no way to return.
    pattern = f"((?>{unit}))*+"

    def filled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = regex.compile(pattern)
        for batch in batch_slices(batches, "text"):
            keys = batch.column("key").to_pylist()
            texts = (t.as_py() or "" for t in batch.column("text"))
            made = [rearranged(units, t, _drawn(seed, k or ""), changed, suffix_first) for k, t in zip(keys, texts, strict=True)]
            fields = list(zip(*made, strict=True)) if made else [()] * 5
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]
            arrays = [pa.array(list(f), k) for f, k in zip(fields, kinds, strict=True)]
            fim = pa.StructArray.from_arrays(arrays, _FILLED.names)
            yield pa.RecordBatch.from_arrays([batch.column("row"), fim], ["row", "fim"])

    rows = docs.select(
        F.struct("*").alias("row"), F.col("doc_id").cast("string").alias("key"), "text"
    )
    return rows.mapInArrow(filled, StructType([StructField("row", docs.schema), StructField("fim", _FILLED)]))


def restored(output: Column, form: Column) -> Column:
    """The exact text from an output and its form; a mark occurs once in what is not plain."""
    after = lambda mark: F.substring_index(output, mark, -1)
    before = lambda text, mark: F.substring_index(text, mark, 1)
    middle = after(MIDDLE)
    psm = F.concat(before(after(PREFIX), SUFFIX), middle, before(after(SUFFIX), MIDDLE))
    spm = F.concat(before(after(PREFIX), MIDDLE), middle, before(after(SUFFIX), PREFIX))
    return F.when(form == "plain", output).when(form == "psm", psm).when(form == "spm", spm)
