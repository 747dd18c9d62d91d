"""Near duplicates of vectors: binary codes of randomly rotated vectors, then exact cosines."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from math import acos, ceil, log, log2, pi

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlake.llm.common import group_bounds, list_matrix, merge_labels, split_buckets, stored, whole_groups
from postlake.llm.components import connected_components

SEED = 42
CODE_BITS = 256
FOUND = 0.999
_WIDTHS = 4.0
_BUCKET_ROWS = 2048
_USUAL_BUCKET = 128
# Keys of different labels, lengths or masks can collide; the groups compared cannot.
_GROUP = ["bucket", "mask", "label", "dims", "low", "high"]


@lru_cache(maxsize=4)
def rotation(dims: int, bits: int) -> np.ndarray:
    """A seeded ``bits x dims`` matrix with orthonormal columns: padding to ``bits`` and a random rotation."""
    drawn = np.random.default_rng([SEED, dims, bits]).standard_normal((bits, dims))
    q, r = np.linalg.qr(drawn)
    return q * np.sign(np.diag(r))


def code_bits(dims: int) -> int:
    return max(CODE_BITS, 64 * ceil(dims / 64))


def encode(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sign codes (as packed 64-bit words) of the rotated unit vectors, and the correction factor of each:
    the inner product of the unit vector with its code vector."""
    bits = code_bits(vectors.shape[1])
    turned = vectors @ rotation(vectors.shape[1], bits).T
    words = np.packbits(turned > 0, axis=1, bitorder="little").view(np.int64)
    return words, np.abs(turned).sum(axis=1) / np.sqrt(bits)


def estimates(codes: np.ndarray, factors: np.ndarray, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unbiased inner products of coded unit vectors (rows) with ``vectors`` (columns), and the half-width of
    each row's confidence bound."""
    bits = codes.shape[1] * 64
    signs = np.unpackbits(codes.view(np.uint8), axis=1, bitorder="little").astype(np.float64) * 2 - 1
    turned = vectors @ rotation(vectors.shape[1], bits).T
    raw = signs @ turned.T / np.sqrt(bits)
    width = _WIDTHS * np.sqrt(np.maximum(1 - factors**2, 0) / factors**2 / (bits - 1))
    return raw / factors[:, None], width


def _unit(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)  # keeps squares in range
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def usable() -> Column:
    """Vectors that can link: labelled, with finite components that are not all zero."""
    finite = lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False))
    return F.coalesce(
        F.col("label").isNotNull() & F.forall("embedding", finite) & F.exists("embedding", lambda x: x != 0.0),
        F.lit(False),
    )


def _masks(rows: int, threshold: float, bits: int) -> list[int]:
    """Masks of random code bits such that a pair at the threshold agrees under one of them with
    probability ``FOUND``; the bits of a mask grow with the logarithm of the rows of a label."""
    per_mask = max(2, ceil(log2(max(rows, 2) / _USUAL_BUCKET)))
    same = 1 - acos(threshold) / pi
    many = ceil(log(1 - FOUND) / log(1 - same**per_mask))
    draw = np.random.default_rng(SEED)
    return [sum(1 << int(b) for b in draw.choice(bits, min(per_mask, bits), replace=False)) for _ in range(many)]


def _word(mask: int, w: int) -> int:
    x = (mask >> (64 * w)) & ((1 << 64) - 1)
    return x - (1 << 64) if x >> 63 else x


def _codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes = pc.list_value_length(batch.column("embedding")).to_numpy(zero_copy_only=False)
        words = [None] * batch.num_rows
        factor = np.zeros(batch.num_rows)
        for dims in np.unique(sizes).tolist():
            rows = np.flatnonzero(sizes == dims)
            vectors = _unit(list_matrix(batch.column("embedding").take(pa.array(rows)), dims, np.float64))
            coded, factor[rows] = encode(vectors)
            for row, code in zip(rows.tolist(), coded, strict=True):
                words[row] = code
        columns = [pa.array(words, pa.list_(pa.int64())), pa.array(factor)]
        yield pa.RecordBatch.from_arrays([*batch.columns, *columns], [*batch.schema.names, "code", "factor"])


def _linked(batches: Iterator[pa.RecordBatch], masks: list[int], threshold: float) -> Iterator[pa.RecordBatch]:
    """``(node, other, n_links)``: links of a node found here first, and its smallest companion here."""
    for table in whole_groups(batches, _GROUP):
        for first, last in zip(*group_bounds(table, _GROUP), strict=True):
            if last - first > 1:
                yield from _group_links(table.slice(first, last - first), masks, threshold)


def _group_links(group: pa.Table, masks: list[int], threshold: float) -> Iterator[pa.RecordBatch]:
    low, high = group.column("low")[0].as_py(), group.column("high")[0].as_py()
    part, node = group.column("part").to_numpy(), group.column("node").to_numpy()
    copies, factor = group.column("copies").to_numpy(), group.column("factor").to_numpy()
    dims = len(group.column("embedding")[0])
    vectors = _unit(list_matrix(group.column("embedding"), dims, np.float64))
    codes = np.ascontiguousarray(list_matrix(group.column("code"), code_bits(dims) // 64, np.int64))
    mask_words = np.array([[_word(m, w) for w in range(codes.shape[1])] for m in masks])
    this = group.column("mask")[0].as_py()
    rows = np.flatnonzero(part == low)
    columns = rows if low == high else np.flatnonzero(part == high)
    label, links = np.arange(len(node)), np.zeros(len(node), np.int64)
    for begin in range(0, len(rows), 512):
        some = rows[begin : begin + 512]
        guess, width = estimates(codes[some], factor[some], vectors[columns])
        i, j = np.nonzero(guess + width[:, None] >= threshold)
        i, j = some[i], columns[j]
        if low == high:
            i, j = i[i < j], j[i < j]
        exact = np.einsum("ij,ij->i", vectors[i], vectors[j])
        i, j = i[exact >= threshold], j[exact >= threshold]
        merge_labels(label, i, j)
        differ = codes[i] ^ codes[j]
        new = np.ones(len(i), bool)
        for earlier in mask_words[:this]:
            new &= ((differ & earlier) != 0).any(axis=1)
        np.add.at(links, i[new], copies[j[new]])
        np.add.at(links, j[new], copies[i[new]])
    found = np.flatnonzero((links > 0) | (label != np.arange(len(node))))
    columns = [pa.array(node[found]), pa.array(node[label[found]]), pa.array(links[found])]
    yield pa.RecordBatch.from_arrays(columns, ["node", "other", "n_links"])


def embedding_links(vectors: DataFrame, threshold: float = 0.93) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` for every row of ``vectors(vec_id, embedding, label, …)``.

    Rows link when label and length are equal and the cosine, in double precision, is at least
    ``threshold``. Equal vectors of a label are one node and count as many as they are. A node's code
    has a bit for each direction of a random rotation; nodes meet in buckets of code bits, and within a
    bucket the code's inner-product estimate plus its confidence bound (four standard widths) decides
    which pairs are computed exactly. Masks are as many as find a pair at the threshold in 999 of 1,000 cases, closer pairs more
    often; a pair counts under the first mask that shows it, so no list of pairs is made. Buckets of
    over two thousand nodes are split into pairs of parts.

    Vectors without label, null, empty, zero, or with null or non-finite components link with nothing
    and keep themselves. A null id never is a component's smallest; repeated rows are rows of their own;
    other columns are ignored; an empty table gives no rows.
    """
    given = vectors.select("vec_id", "embedding", "label").withColumn("_usable", usable())
    alike = given.filter("_usable").groupBy("label", "embedding").agg(
        F.count("*").alias("copies"), F.min("vec_id").alias("first_id")
    )
    nodes = alike.withColumn("node", F.monotonically_increasing_id())
    kinds = dict(nodes.dtypes)
    schema = ", ".join(f"{c} {kinds[c]}" for c in nodes.columns) + ", code array<bigint>, factor double"
    coded = stored(nodes.mapInArrow(_codes, schema), "vector-codes")
    most, widest = coded.groupBy("label").agg(F.count("*").alias("n"), F.max(F.size("code")).alias("w")).agg(
        F.max("n"), F.max("w")
    ).first()
    masks = _masks(most or 0, threshold, CODE_BITS)
    words = range(min(widest or 1, CODE_BITS // 64))
    seen = [
        F.struct(
            F.lit(m).alias("mask"),
            F.xxhash64(
                F.lit(m), "label", F.size("embedding"),
                *[F.get("code", F.lit(w)).bitwiseAND(F.lit(_word(mask, w)).cast("bigint")) for w in words],
            ).alias("bucket"),
        )
        for m, mask in enumerate(masks)
    ]
    shown = F.explode(F.array(*seen)).alias("_b")
    dims = F.size("embedding").alias("dims")
    named = coded.select("label", dims, "node", "copies", "embedding", "code", "factor", shown)
    placed = split_buckets(named.select("*", "_b.*").drop("_b"), "bucket", "node", _BUCKET_ROWS)
    sorted_ = placed.repartition("bucket", "low", "high").sortWithinPartitions(*_GROUP)
    links = stored(
        sorted_.mapInArrow(
            lambda batches: _linked(batches, masks, threshold), "node bigint, other bigint, n_links bigint"
        ),
        "vector-links",
    )
    members = connected_components(links, "node", "other")
    smallest = members.join(coded.select("node", "first_id"), "node").groupBy("component").agg(
        F.min("first_id").alias("_component_id")
    )
    component = members.join(smallest, "component").select("node", "_component_id")
    degree = links.groupBy("node").agg(F.sum("n_links").alias("_links"))
    classes = coded.join(degree, "node", "left").join(component, "node", "left").select(
        F.col("label"), F.col("embedding"), F.lit(True).alias("_usable"),
        (F.coalesce("_links", F.lit(0)) + F.col("copies") - 1).alias("_n_links"),
        F.coalesce("_component_id", "first_id").alias("_component_id"),
    )
    return given.join(classes, ["label", "embedding", "_usable"], "left").select(
        "vec_id",
        F.coalesce("_n_links", F.lit(0).cast("bigint")).alias("n_links"),
        F.when(F.col("_n_links").isNull(), F.col("vec_id")).otherwise(F.col("_component_id")).alias("component_id"),
    ).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
