"""One JSON document of any size, read and written by many tasks.

A document ``{"metadata": …, "posts": […]}`` or a bare list ``[…]`` of posts is one JSON value, which no
line ends. It is read in pieces that end at a closing brace, wherever that stands, so that file splits
are read apart. Pieces of a split that follow each other make a chunk, which is stored. What a chunk does to quotes
and brackets is summed up for both cases, inside and outside a string; running sums over the chunks of a
split and then over the splits tell which case holds and how deep it begins. A post ends where the depth returns to
that of the list of posts, so each chunk is cut into posts by itself; only what a chunk's ends cut off is shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from postlake.operators.posts import POST_FIELDS
from postlake.session import importable_by_workers, remove, shared_folder, shuffles_dropped
from postlake.sources.readers import posts_of
from postlake.sources.schemas import DOCUMENT_POST
from postlake.sources.sinks import brackets, enriched_json, post_json

_SPLIT = ["doc", "file", "block"]
_PLACE = [*_SPLIT, "nr"]
_CHUNK_BYTES = 1 << 20
_EFFECT = "struct<delta: bigint, least: bigint>"
_CHUNK = (
    "file string, block bigint, nr bigint, text string, n_bytes bigint, file_bytes bigint, quotes bigint, "
    f"out {_EFFECT}, within {_EFFECT}, first string, named boolean"
)
_PART = "doc string, file string, block bigint, nr bigint, part int, text string, done boolean, lone boolean"
# The list of posts begins behind these signs, if they stand outside a string at depth 1.
_LIST = re.compile(rb'"posts"[^"\[\]{}:,]*:[^"\[\]{}:,]*\[')
_STEP = np.zeros(256, np.int64)
_STEP[list(b"[{")], _STEP[list(b"]}")] = 1, -1
_IS_SIGN = _STEP != 0
_IS_SIGN[ord('"')] = True
# Rows are up to a chunk long: pages and row groups are ended by their bytes, whatever the number of rows.
_LONG_ROWS = {
    "compression": "zstd", "parquet.block.size": str(8 << 20),
    "parquet.block.size.row.check.min": "1", "parquet.page.size.row.check.min": "1",
}


def _stored(frame: DataFrame, path: str) -> DataFrame:
    with shuffles_dropped(frame.sparkSession):
        frame.write.options(**_LONG_ROWS).parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def _signs(text: bytes, inside: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of quotes and brackets without a backslash before them, which of them are quotes, and each one's step of depth.

    Inside strings brackets have step 0. A brace ends a piece even behind a backslash, which JSON has no use for.
    """
    data = np.frombuffer(text, np.uint8)
    at = np.flatnonzero(_IS_SIGN[data])
    slashes = np.flatnonzero(data == ord("\\"))
    if len(slashes):
        begins = np.maximum.accumulate(np.where(np.diff(slashes, prepend=-2) != 1, slashes, 0))
        last = np.searchsorted(slashes, at) - 1
        escaped = (last >= 0) & (slashes[last] == at - 1) & ((at - begins[last]) % 2 == 1) & (data[at] != ord("}"))
        at = at[~escaped]
    quotes = data[at] == ord('"')
    in_string = (np.cumsum(quotes) + inside) % 2 == 1
    return at, quotes, np.where(in_string, 0, _STEP[data[at]])


def _summary(text: bytes) -> dict:
    """What a chunk does up to its last brace, begun outside or inside a string."""
    summed = {}
    for name, inside in (("out", False), ("within", True)):
        _, quotes, steps = _signs(text, inside)
        depth = np.cumsum(steps[:-1])
        summed[name] = {"delta": int(depth[-1]) if len(depth) else 0, "least": int(min(0, depth.min(initial=0)))}
    return summed | {"quotes": int(quotes.sum()), "n_bytes": len(text), "named": b'"posts"' in text}


def _split_slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Rows of one split each, with at most some ``_CHUNK_BYTES`` or one row."""
    file = batch.column("file").dictionary_encode().indices.to_numpy(zero_copy_only=False)
    block = batch.column("block").to_numpy(zero_copy_only=False)
    size = np.cumsum(pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False).astype(np.int64)) // _CHUNK_BYTES
    change = np.flatnonzero((np.diff(file) != 0) | (np.diff(block) != 0) | (np.diff(size) != 0)) + 1
    for begin, end in zip([0, *change], [*change, batch.num_rows], strict=True):
        yield batch.slice(begin, end - begin)


def _chunked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces ``(file, block, file_bytes, text)`` in file order as chunks, each piece with a brace behind it."""
    schema = pa.schema([
        ("file", pa.string()), ("block", pa.int64()), ("nr", pa.int64()), ("text", pa.binary()), ("n_bytes", pa.int64()),
        ("file_bytes", pa.int64()), ("quotes", pa.int64()),
        *[(n, pa.struct([("delta", pa.int64()), ("least", pa.int64())])) for n in ("out", "within")],
        ("first", pa.string()), ("named", pa.bool_()),
    ])
    nr = TaskContext.get().partitionId() << 33
    held: list[bytes] = []
    split, size = None, 0

    def chunk() -> pa.RecordBatch:
        text = b"}".join(held) + b"}"
        first = held[0].decode(errors="replace").lstrip(" \t\n\x0b\f\r\ufeff")[:1]
        row = split | {"nr": nr, "text": text, "first": first} | _summary(text)
        made = pa.RecordBatch.from_pylist([row], schema)
        return _with_texts(made)

    for batch in batches:
        for some in _split_slices(batch) if batch.num_rows else ():
            here = some.slice(0, 1).select(["file", "block", "file_bytes"]).to_pylist()[0]
            if held and (here != split or size >= _CHUNK_BYTES):
                yield chunk()
                held, size, nr = [], 0, nr + 1
            split = here
            held += some.column("text").cast(pa.binary()).to_pylist()
            size = sum(map(len, held)) + len(held)
    if held:
        yield chunk()


def _with_texts(batch: pa.RecordBatch) -> pa.RecordBatch:
    """``text`` as a string, its bytes as they are."""
    k = batch.schema.get_field_index("text")
    return batch.set_column(k, "text", batch.column(k).view(pa.string()))


def _pieces(spark: SparkSession, path: str | list[str], whole: bool, folder: str | None = None) -> DataFrame:
    """Stored chunks of pieces ``(doc, file, block, nr, text, n_bytes, file_bytes, quotes, out, within, first, named)``.

    They are stored once with their order, since a second scan could be split in other places. A chunk is some
    ``_CHUNK_BYTES`` long, or one piece; ``nr`` rises within a split and is given once.
    """
    importable_by_workers(spark)
    read = spark.read.option("lineSep", "}").text(path)
    placed = read.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.col("_metadata.file_size").alias("file_bytes"),
        F.col("value").alias("text"),
    )
    chunks = placed.mapInArrow(_chunked, _CHUNK)
    doc = F.lit("") if whole else F.col("file")
    return _stored(chunks.withColumn("doc", doc), folder or shared_folder(spark, "document-pieces"))


def _with_state(pieces: DataFrame) -> DataFrame:
    """For every chunk ``closed`` (a brace ends it), ``inside`` (a string), ``depth`` before, ``least`` and ``after``; no text."""
    pieces = pieces.drop("text")
    in_split = Window.partitionBy(*_SPLIT).orderBy("nr")
    before = in_split.rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("bigint")
    sizes = pieces.groupBy(*_SPLIT).agg(
        F.sum("n_bytes").alias("_bytes"), F.max("file_bytes").alias("_size"), F.max("nr").alias("_last")
    )
    of_file = Window.partitionBy("file")
    open_end = (F.col("block") == F.max("block").over(of_file)) & (F.sum("_bytes").over(of_file) > F.max("_size").over(of_file))
    known = pieces.join(sizes.select(*_SPLIT, F.when(open_end, F.col("_last")).alias("_open")).hint("merge"), _SPLIT)
    known = known.withColumn("closed", ~F.col("nr").eqNullSafe(F.col("_open"))).drop("_open")
    known = known.withColumn("_odd", F.coalesce(F.sum("quotes").over(before), zero) % 2)

    def run(first: int) -> Column:
        """The effect of a piece, its brace included, in a split that begins outside (0) or inside (1) a string."""
        inside = (F.col("_odd") + first) % 2
        ends_inside = (inside + F.col("quotes")) % 2
        effect = F.when(inside == 0, F.col("out.delta")).otherwise(F.col("within.delta"))
        return effect - F.when(F.col("closed") & (ends_inside == 0), 1).otherwise(0)

    known = known.withColumns({"_run0": run(0), "_run1": run(1)})
    known = known.withColumns({f"_sum{i}": F.coalesce(F.sum(f"_run{i}").over(before), zero) for i in (0, 1)})
    # One row per split: a document has as many as its files have.
    splits = known.groupBy(*_SPLIT).agg(
        F.sum("quotes").alias("_quotes"), F.sum("_run0").alias("_run0"), F.sum("_run1").alias("_run1")
    )
    over = Window.partitionBy("doc").orderBy("file", "block").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.withColumn("_starts", F.coalesce(F.sum("_quotes").over(over), zero) % 2)
    own = F.when(F.col("_starts") == 0, F.col("_run0")).otherwise(F.col("_run1"))
    splits = splits.withColumn("_base", F.coalesce(F.sum(own).over(over), zero)).select(*_SPLIT, "_starts", "_base")
    joined = known.join(splits.hint("merge"), _SPLIT)
    pick = lambda name: F.when(F.col("_starts") == 0, F.col(f"{name}0")).otherwise(F.col(f"{name}1"))
    joined = joined.withColumn("inside", (F.col("_odd") + F.col("_starts")) % 2 == 1)
    effect = F.when(F.col("inside"), F.col("within")).otherwise(F.col("out"))
    depth = F.col("_base") + pick("_sum")
    return joined.select(
        *_PLACE, "first", "named", "closed", "inside", depth.alias("depth"), (depth + effect["least"]).alias("least"),
        (depth + pick("_run")).alias("after"),
    )


def _list_begins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(nr, at, ends)`` of the chunks in which the list of posts begins and is still open at the end of its piece.

    The list is the value of the key ``posts`` at depth 1; a bracket elsewhere, in strings too, is none. ``ends``: in the same chunk.
    """
    for batch in batches:
        found: dict[str, list] = {"nr": [], "at": [], "ends": []}
        columns = {name: batch.column(name) for name in batch.schema.names}
        texts = columns["text"].cast(pa.binary())
        for i in range(batch.num_rows):
            text = texts[i].as_py()
            at, _, steps = _signs(text, columns["inside"][i].as_py())
            depth = columns["depth"][i].as_py() + np.cumsum(steps)
            for match in _LIST.finditer(text):
                begin = match.end()
                key, bracket = np.searchsorted(at, [match.start(), begin - 1])
                if at[key] != match.start() or at[bracket] != begin - 1 or steps[bracket] != 1 or depth[bracket] != 2:
                    continue
                low = at[bracket:][depth[bracket:] < 2]
                if not len(low) or low[0] >= text.index(b"}", begin):
                    end = len(text) if columns["closed"][i].as_py() else len(text) - 1
                    for name, value in (("nr", columns["nr"][i].as_py()), ("at", begin), ("ends", bool((low < end).any()))):
                        found[name].append(value)
                    break
        types = {"nr": pa.int64(), "at": pa.int64(), "ends": pa.bool_()}
        yield pa.RecordBatch.from_arrays([pa.array(found[name], kind) for name, kind in types.items()], list(types))


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Parts of chunks: ``lone`` ones are posts, of others the one that is ``done`` ends a post that began in an earlier chunk."""
    names = [field.split()[0] for field in _PART.split(", ")]
    for batch in batches:
        columns = {name: batch.column(name) for name in batch.schema.names}
        texts = columns["text"].cast(pa.binary())
        for i in range(batch.num_rows):
            row = {name: column[i].as_py() for name, column in columns.items() if name != "text"}
            text = texts[i].as_py()
            at, _, steps = _signs(text, row["inside"])
            end = len(text) if row["closed"] else len(text) - 1
            shown = at < end
            at, steps = at[shown], steps[shown]
            depth = row["depth"] + np.cumsum(steps)
            begin = row["begin"] or 0
            low = np.flatnonzero((depth < row["level"]) & (at >= begin))
            if row["level"] == 2:
                if row["begin"] is None and row["depth"] < 2:
                    continue
                end = int(at[low[0]]) if len(low) else end
            braces = np.frombuffer(text, np.uint8)[at] == ord("}")
            cuts = at[braces & (steps == -1) & (depth == row["level"]) & (at >= begin) & (at < end)] + 1
            bounds = [begin, *cuts.tolist(), end]
            parts = [text[a:b] for a, b in zip(bounds, bounds[1:], strict=False)]
            n, done = len(parts), [True] * len(cuts) + [False]
            lone = [k > 0 or row["begin"] is not None for k in range(len(cuts))] + [False]
            made = [
                *[pa.array([row[name]] * n, kind) for name, kind in (("doc", pa.string()), ("file", pa.string()), ("block", pa.int64()), ("nr", pa.int64()))],
                pa.array(range(n), pa.int32()), pa.array(parts, pa.binary()), pa.array(done), pa.array(lone),
            ]
            yield _with_texts(pa.RecordBatch.from_arrays(made, names))


def _parts(spark: SparkSession, path: str | list[str], whole: bool) -> DataFrame:
    """Stored parts of the chunks that hold posts: whole posts, and what the ends of a chunk cut off."""
    folder = shared_folder(spark, "document-pieces")
    pieces = _pieces(spark, path, whole, folder)
    states = _stored(_with_state(pieces), shared_folder(spark, "document-states"))
    place = F.struct("file", "block", "nr")
    docs = states.groupBy("doc").agg(F.min_by("first", place).alias("_first"), F.max_by("after", place).alias("_final"))
    docs = docs.select("doc", "_final", F.when(F.col("_first") == "[", 1).otherwise(2).alias("level"))
    splits = states.select(*_SPLIT).distinct().join(docs, "doc")
    known = states.join(splits, _SPLIT)
    low = known.filter((F.col("level") == 2) & (F.col("least") <= 1))
    # The states of chunks, one for each MB of text, go to their texts, not the texts to them.
    asked = F.broadcast(low.filter("named").select("nr", "closed", "inside", "depth"))
    begins = pieces.select("nr", "text").join(asked, "nr").mapInArrow(_list_begins, "nr bigint, at bigint, ends boolean")
    begins = begins.join(low.select(*_PLACE), "nr").groupBy("doc").agg(
        F.min(place).alias("_from"), F.min_by("at", place).alias("_at"), F.min_by("ends", place).alias("_ends")
    )
    splits = splits.join(begins, "doc", "left")
    low = low.select(*_PLACE).join(splits, _SPLIT).filter(place > F.col("_from"))
    splits = splits.join(low.groupBy("doc").agg(F.min(place).alias("_low")), "doc", "left")
    splits = splits.withColumn("_until", F.when(F.col("_ends"), F.col("_from")).otherwise(F.col("_low")))
    broken = F.raise_error(F.concat(F.lit("not a whole JSON document: "), F.col("doc")))
    held = F.when(F.col("_final") != 0, broken).otherwise(
        (F.col("level") == 1) | (F.coalesce(place >= F.col("_from"), F.lit(False)) & F.coalesce(place <= F.col("_until"), F.lit(True)))
    )
    begin = F.when((F.col("level") == 2) & (place == F.col("_from")), F.col("_at")).alias("begin")
    told = states.join(splits, _SPLIT).filter(held).select("nr", "closed", "inside", "depth", "level", begin)
    cut = pieces.select(*_PLACE, "text").join(F.broadcast(told), "nr").mapInArrow(_cut, _PART)
    parts = _stored(cut, shared_folder(spark, "document-parts"))
    remove(spark, folder)
    return parts


def _post_texts(spark: SparkSession, path: str | list[str], whole: bool) -> DataFrame:
    """``(doc, text)`` of every post of the documents at ``path``."""
    parts = _parts(spark, path, whole)
    cut_off = parts.filter(~F.col("lone")).withColumn("_done", F.col("done").cast("bigint"))
    in_split = Window.partitionBy(*_SPLIT).orderBy("nr", "part").rowsBetween(Window.unboundedPreceding, -1)
    counted = cut_off.withColumn("_earlier", F.coalesce(F.sum("_done").over(in_split), F.lit(0)))
    over = Window.partitionBy("doc").orderBy("file", "block").rowsBetween(Window.unboundedPreceding, -1)
    splits = cut_off.groupBy(*_SPLIT).agg(F.sum("_done").alias("_sum"))
    splits = splits.select(*_SPLIT, F.coalesce(F.sum("_sum").over(over), F.lit(0)).alias("_offset"))
    named = counted.join(splits.hint("merge"), _SPLIT).withColumn("post", F.col("_offset") + F.col("_earlier"))
    own = F.struct(*_PLACE, "part", "text", "_done")
    joined = named.groupBy("doc", "post").agg(F.array_sort(F.collect_list(own)).alias("_pieces"))
    joined = joined.filter(F.exists("_pieces", lambda p: p["_done"] == 1))
    joined = joined.select("doc", F.array_join(F.transform("_pieces", lambda p: p["text"]), "").alias("text"))
    every = parts.filter("lone").select("doc", "text").unionByName(joined)
    return every.select("doc", F.regexp_replace("text", r"^[^{]*", "").alias("text"))


def read_large_posts(spark: SparkSession, path: str | list[str], whole: bool = False) -> DataFrame:
    """As ``read_posts`` with ``multi_line``, for documents of any size: one in each file, or, if ``whole``, all files
    in the order of their names make one.

    No task reads more than a split of a file or, later, the parts of a post. The text is stored twice, in chunks and,
    when those are removed, in posts; shuffled is what the ends of chunks cut off. Posts are objects; other elements of a list are left
    out, if no brace is in them. A document whose brackets do not close is an error, as is a post that is no JSON.
    """
    texts = _post_texts(spark, path, whole)
    options = {"mode": "FAILFAST"}
    post = F.from_json("text", f"metadata string, enrichment_summary string, {DOCUMENT_POST}", options)
    return posts_of(texts.select(post.alias("_post")).select("_post.*", F.lit(None).cast(f"array<struct<{DOCUMENT_POST}>>").alias("posts")))


def write_large_document(
    posts: DataFrame,
    path: str,
    order: Sequence[str],
    metadata_json: str | None = None,
    summary_json: str | None = None,
    enriched: bool = False,
) -> None:
    """One document, summary first, in numbered part files: put together in the order of their names they are valid JSON.

    Posts stand in the given ``order``, one a line; only the first has no comma before it. They are written
    by as many tasks as the sort has. With ``enriched`` details are written as ``write_enriched`` does, else
    the post fields. Without posts the list is empty, without metadata and summary the document is a bare list.
    """
    spark = posts.sparkSession
    opening, closing = brackets(metadata_json, summary_json)
    json = enriched_json(posts) if enriched else post_json(POST_FIELDS)
    folder = shared_folder(spark, "document-lines")
    lines = _stored(posts.select(*order, json.alias("_json")).withColumn("_id", F.monotonically_increasing_id()), folder)
    place = F.struct(*order, "_id")
    first = lines.agg(F.min(place)).scalar()
    comma = F.when(place.eqNullSafe(first), "").otherwise(",")
    sorted_ = lines.orderBy(*order, "_id").select(F.concat(comma, F.col("_json")).alias("value"))
    edge = lambda text: spark.range(1, numPartitions=1).select(F.lit(text).alias("value"))
    with shuffles_dropped(spark):
        edge(opening).unionByName(sorted_).unionByName(edge(closing)).write.mode("overwrite").text(path)
    remove(spark, folder)
