"""A Merkle manifest of a table: hash trees whose parents keep the states of their hash before each child.

Leaves of one tree are cut into blocks of consecutive ones, each block is hashed up to one node, and
those nodes are the leaves of the next round, so no task sees more than a block. The roots of all trees
are the leaves of a top tree. A replaced leaf is folded upwards with what the parents keep: the state
before its slot, the replacement, and the siblings to its right.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postlake.llm.common import stored
from postlake.llm.sha_states import DIGEST_BYTES, START, finished, from_bytes, hex_blocks, resumed, to_bytes

ARITY, BLOCK_LEVELS = 2, 12
_PART_BITS = 33
_BLOCK_KEY = ["tree", "block"]
_NODE = "tree string, block bigint, size bigint, nodes binary, states binary, digest binary"


def digest_of(columns: list[Column]) -> Column:
    """Lowercase hex sha256 of ``-`` for a null and of byte count, colon and value for others, one after another."""

    def told(value: Column) -> Column:
        text = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.sha2(F.concat(*[told(c) for c in columns]), 256)


@dataclass(frozen=True)
class _Level:
    """The nodes of one level of a block, and their parents' states before the second and later slots."""

    nodes: np.ndarray
    states: np.ndarray

    def places(self, at: np.ndarray, arity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Parent, slot and number of siblings, itself included, of the nodes ``at``."""
        parent = at // arity
        return parent, at % arity, np.minimum(arity, self.nodes.shape[1] - parent * arity)


def _levels_up(size: int, arity: int, most: int) -> int:
    """How many levels a block of a tree with ``size`` leaves has: up to one node, or to the block's height."""
    levels = 0
    while size > 1 and levels < most:
        size, levels = -(-size // arity), levels + 1
    return levels


def _climbed(leaves: np.ndarray, arity: int, levels: int) -> tuple[list[_Level], np.ndarray]:
    """The levels of a block from its leaves upwards, and the digest of its last node."""
    nodes, found = leaves, []
    for _ in range(levels):
        many = nodes.shape[1]
        first = np.arange(0, many, arity)
        state, before = np.repeat(START, len(first), axis=1), []
        for slot in range(arity):
            if slot:
                before.append(state.copy())
            held = first + slot < many
            state[:, held] = resumed(state[:, held], hex_blocks(nodes[:, first[held] + slot]))
        found.append(_Level(nodes, np.stack(before)))
        nodes = finished(state, np.minimum(arity, many - first))
    return found, nodes


def _stored_levels(raw_nodes: bytes, raw_states: bytes, count: int, arity: int, levels: int) -> list[_Level]:
    """The levels of a block as it was stored."""
    nodes, states = from_bytes(raw_nodes), from_bytes(raw_states)
    found, node, state = [], 0, 0
    for _ in range(levels):
        parents = -(-count // arity)
        kept = states[:, state : state + parents * (arity - 1)].reshape(8, arity - 1, parents).transpose(1, 0, 2)
        found.append(_Level(nodes[:, node : node + count], kept))
        node, state, count = node + count, state + parents * (arity - 1), parents
    return found


def _lifted(values: np.ndarray, at: np.ndarray, level: _Level, arity: int) -> np.ndarray:
    """What the parents of the nodes ``at`` become when each has ``values`` in that place."""
    parent, slot, siblings = level.places(at, arity)
    state = np.repeat(START, len(at), axis=1)
    for s in range(1, arity):
        late = slot == s
        state[:, late] = level.states[s - 1][:, parent[late]]
    state = resumed(state, hex_blocks(values))
    for right in range(1, arity):
        held = slot + right < siblings
        if held.any():
            state[:, held] = resumed(state[:, held], hex_blocks(level.nodes[:, at[held] + right]))
    return finished(state, siblings)


def _siblings(at: np.ndarray, level: _Level, arity: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """The other children of the nodes' parents from left to right: digests, and where there are such."""
    parent, slot, siblings = level.places(at, arity)
    found = []
    for other in range(arity - 1):
        place = other + (other >= slot)
        held = place < siblings
        found.append((level.nodes[:, np.where(held, parent * arity + place, 0)], held))
    return found


def _step(at: int, level: _Level, arity: int) -> bytes:
    """One level of a path: slot, siblings, the state before the slot, and the other children."""
    where = np.array([at])
    parent, slot, siblings = (int(x[0]) for x in level.places(where, arity))
    state = level.states[slot - 1][:, [parent]] if slot else START
    others = b"".join(to_bytes(nodes) for nodes, held in _siblings(where, level, arity) if held[0])
    return bytes([slot, siblings]) + to_bytes(state) + others


def _steps(path: bytes) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(slot, siblings, state, other children)`` of every level of a path."""
    at = 0
    while at < len(path):
        slot, siblings = path[at], path[at + 1]
        end = at + 2 + DIGEST_BYTES * siblings
        held = from_bytes(path[at + 2 : end])
        yield slot, siblings, held[:, :1], held[:, 1:]
        at = end


def _ranked(rows: DataFrame, tree: str, order: list[str]) -> DataFrame:
    """Add ``index``, the place of a row among those of its ``tree`` in the given order, and their ``size``.

    Rows are sorted by ranges, and equal ones are told apart, so no tree meets in one task; places come
    from counts per range.
    """
    order = [tree, *order, "_tie"]
    ranged = rows.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(*order)
    placed = ranged.sortWithinPartitions(*order).drop("_tie").withColumn("_place", F.monotonically_increasing_id())
    placed = stored(placed, "ordered").withColumn("_part", F.shiftright("_place", _PART_BITS))
    earlier = Window.partitionBy(tree).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counted = placed.groupBy(tree, "_part").agg(F.min("_place").alias("_first"), F.count("*").alias("_rows"))
    parts = counted.select(
        tree, "_part", (F.coalesce(F.sum("_rows").over(earlier), F.lit(0)) - F.col("_first")).alias("_shift"),
        F.sum("_rows").over(Window.partitionBy(tree)).alias("size"),
    )
    return placed.join(parts, [tree, "_part"]).select(
        *rows.columns, (F.col("_place") + F.col("_shift")).alias("index"), "size"
    )


@dataclass(frozen=True)
class Manifest:
    """Stored hash trees: leaves with their places, and a table of blocks for every round upwards.

    ``leaves`` is ``(…, tree, digest, index, size, block)``; ``rounds`` go from the leaves to the root of each
    tree, ``top`` from those, which ``trees`` (``(tree, index, …)``) lists, to the root of all. A block has
    its leaves and nodes above them, level by level, and the parents' states.
    """

    leaves: DataFrame
    rounds: list[DataFrame]
    trees: DataFrame
    top: list[DataFrame]
    arity: int
    levels: int

    @property
    def block_leaves(self) -> int:
        return self.arity**self.levels


def _with_block(nodes: DataFrame, most: int) -> DataFrame:
    return nodes.withColumn("block", F.floor(F.col("index") / most).cast("bigint"))


def _hashed(nodes: DataFrame, arity: int, levels: int) -> list[DataFrame]:
    """The rounds of blocks over ``(tree, index, size, digest)`` until every tree has one node left."""

    def block(group: pa.Table) -> pa.Table:
        group = group.sort_by("index")
        size = group.column("size")[0].as_py()
        leaves = from_bytes(b"".join(group.column("digest").to_pylist()))
        found, root = _climbed(leaves, arity, _levels_up(size, arity, levels))
        raw_states = b"".join(to_bytes(s) for level in found for s in level.states)
        raw_nodes = b"".join(to_bytes(level.nodes) for level in found) or to_bytes(leaves)
        columns = [[group.column("tree")[0].as_py()], [group.column("block")[0].as_py()], [size], [raw_nodes], [raw_states], [to_bytes(root)]]
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], [f.split()[0] for f in _NODE.split(", ")])

    rounds, most = [], arity**levels
    while True:
        sizes = nodes.agg(F.max("size")).first()[0] or 0
        grouped = _with_block(nodes, most).select("tree", "block", "index", "size", "digest")
        rounds.append(stored(grouped.groupBy(*_BLOCK_KEY).applyInArrow(block, _NODE), "blocks"))
        if sizes <= most:
            return rounds
        up = F.ceil(F.col("size") / most).cast("bigint")
        nodes = rounds[-1].select("tree", F.col("block").alias("index"), up.alias("size"), "digest")


def build_manifest(rows: DataFrame, order: list[str], arity: int = ARITY, levels: int = BLOCK_LEVELS) -> Manifest:
    """The hash trees over ``rows(tree, digest, …)``, leaves of a tree in the given ``order``.

    ``tree`` is a string and not null, ``digest`` binary. Every ``arity`` consecutive nodes have a parent,
    the last ones of a level fewer or one, until one node is left; its digest is the hash of its
    children's hex texts. Trees in the order of their names are the leaves of the top tree. Blocks have
    ``arity ** levels`` leaves. Leaves that tie in ``order`` are ordered by digest. No rows give no trees.
    """
    leaves = stored(_with_block(_ranked(rows, "tree", [*order, "digest"]), arity**levels), "leaves")
    rounds = _hashed(leaves.select("tree", "index", "size", "digest"), arity, levels)
    roots = rounds[-1].select(F.lit("").alias("all"), "tree", "digest")
    trees = stored(_ranked(roots, "all", ["tree"]), "trees")
    top = _hashed(trees.select(F.col("all").alias("tree"), "index", "size", "digest"), arity, levels)
    return Manifest(leaves, rounds, trees, top, arity, levels)


def _paths_below(blocks: DataFrame, above: DataFrame, arity: int, levels: int) -> DataFrame:
    """``(tree, index, path)`` of the leaves of ``blocks``, whose roots have the paths ``(tree, block, path)``."""

    def below(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        most = arity**levels
        for batch in batches:
            for tree, block, size, nodes, states, path in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                count = min(most, size - block * most)
                held = _stored_levels(nodes, states, count, arity, _levels_up(size, arity, levels))
                paths = [
                    b"".join(_step(at // arity**up, level, arity) for up, level in enumerate(held)) + path
                    for at in range(count)
                ]
                index = pa.array(range(block * most, block * most + count), pa.int64())
                columns = [pa.array([tree] * count, pa.string()), index, pa.array(paths, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["tree", "index", "path"])

    held = blocks.select("tree", "block", "size", "nodes", "states").join(above, _BLOCK_KEY)
    return held.mapInArrow(below, "tree string, index bigint, path binary")


def _block_paths(manifest: Manifest) -> DataFrame:
    """``(tree, block, path, subroot, root)``: the way from every block of leaves to the root of all."""
    arity, levels = manifest.arity, manifest.levels
    paths = manifest.top[-1].select("tree", "block", F.lit(b"").alias("path"))
    for blocks in reversed(manifest.top):
        paths = _paths_below(blocks, paths, arity, levels).withColumnRenamed("index", "block")
    root = manifest.top[-1].select(F.col("tree").alias("all"), F.col("digest").alias("root"))
    named = manifest.trees.select("all", "tree", F.col("digest").alias("subroot"), F.col("index").alias("block"))
    roots = stored(
        named.join(paths.withColumnRenamed("tree", "all"), ["all", "block"]).join(root, "all")
        .select("tree", "subroot", "root", "path"),
        "tree-paths",
    )
    paths = roots.select("tree", F.lit(0).cast("bigint").alias("block"), "path")
    for blocks in reversed(manifest.rounds[1:]):
        paths = _paths_below(blocks, paths, arity, levels).withColumnRenamed("index", "block")
    return stored(paths.join(roots.select("tree", "subroot", "root"), "tree"), "block-paths")


def _hex(digests: np.ndarray) -> np.ndarray:
    """Hex texts as rows of bytes."""
    return np.ascontiguousarray(hex_blocks(digests).T, ">u4").view(np.uint8).reshape(-1, 2 * DIGEST_BYTES)


def fold(manifest: Manifest, replacement: str) -> DataFrame:
    """``(…, subroot, root, proof_sha256, folded_root)`` for every leaf of a manifest.

    ``replacement`` names a binary column of the leaves: the digest that takes the leaf's place, or null for
    its own. ``folded_root`` is the root with that one leaf replaced, from the states that the parents
    keep before the slots on its way, the replacement and the siblings to the right. ``proof_sha256`` is
    the hash of all siblings' hex texts on the way, from the leaf upwards and from left to right. Other
    columns of the leaves are kept. A task holds one block of leaves.
    """
    arity, levels = manifest.arity, manifest.levels
    kept = [f for f in manifest.leaves.schema.fields if f.name not in {"tree", "index", "size", "block", replacement}]
    added = ["subroot string", "root string", "proof_sha256 string", "folded_root string"]
    schema = manifest.leaves.select(*[f.name for f in kept]).schema
    for field in added:
        schema = schema.add(*field.split())

    def folded(leaves: pa.Table, blocks: pa.Table) -> pa.Table:
        leaves = leaves.sort_by("index")
        held = {name: blocks.column(name)[0].as_py() for name in blocks.column_names}
        count, size = leaves.num_rows, held["size"]
        own = leaves.column("digest").to_pylist()
        values = from_bytes(b"".join(r or d for r, d in zip(leaves.column(replacement).to_pylist(), own, strict=True)))
        at, siblings = np.arange(count), []
        for level in _stored_levels(held["nodes"], held["states"], count, arity, _levels_up(size, arity, levels)):
            siblings += [(_hex(nodes), there) for nodes, there in _siblings(at, level, arity)]
            values, at = _lifted(values, at, level, arity), at // arity
        above = []
        for slot, many, state, others in _steps(held["path"]):
            values = resumed(np.repeat(state, count, axis=1), hex_blocks(values))
            above.append(_hex(others).tobytes())
            for right in range(slot, many - 1):
                values = resumed(values, hex_blocks(np.repeat(others[:, [right]], count, axis=1)))
            values = finished(values, np.full(count, many))
        rest = b"".join(above)
        proofs = [
            hashlib.sha256(b"".join(hexes[i].tobytes() for hexes, there in siblings if there[i]) + rest).hexdigest()
            for i in range(count)
        ]
        text = lambda name: [held[name].hex()] * count
        found = [text("subroot"), text("root"), proofs, [x.tobytes().decode() for x in _hex(values)]]
        columns = [leaves.column(f.name) for f in kept] + [pa.array(x, pa.string()) for x in found]
        return pa.table(columns, schema.names)

    blocks = manifest.rounds[0].select("tree", "block", "size", "nodes", "states").join(_block_paths(manifest), _BLOCK_KEY)
    both = manifest.leaves.groupBy(*_BLOCK_KEY).cogroup(blocks.groupBy(*_BLOCK_KEY))
    return both.applyInArrow(folded, schema)
