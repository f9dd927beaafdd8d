"""Merkle manifest of a dataset: every row a leaf, a tree per source, and a tree of the sources.

A tree is cut into blocks, aligned subtrees of ``height`` levels. A block is one stored row that
holds its nodes in van Emde Boas order. The roots of a level's blocks are the leaves of the
blocks above, until one root is left; the roots of all sources are the leaves of a last tree.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from holdfast.shipping import ship_package
from holdfast.workspace import materialize

COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
_BLOCK = "key string, block bigint, n bigint, nodes binary, ids array<bigint>, others array<binary>"
_PATHS = "key string, block bigint, path binary, subroot binary"
_PROOFS = (
    "id bigint, leaf string, subroot string, proof_sha256 string, folded_root string, "
    "siblings binary"
)


@dataclass(frozen=True)
class MerkleSpec:
    """``arity`` nodes make their parent; a block has ``height`` levels below its root, so at
    most ``arity ** height`` leaves."""

    arity: int = 3
    height: int = 6

    @property
    def leaves(self) -> int:
        return self.arity**self.height


def sha256_hex(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


@functools.lru_cache(maxsize=64)
def addresses(height: int, arity: int) -> tuple[np.ndarray, ...]:
    """Per depth, where the nodes of a full tree lie in van Emde Boas order.

    The tree is split at half its height: first the top tree, then the trees below it from left
    to right, each laid out by the same rule. So a path from leaf to root crosses few stretches
    of memory, whatever the size of a page or cache line.
    """
    if height == 0:
        return (np.zeros(1, np.int64),)
    upper = (height + 1) // 2  # levels of the top tree
    top, below = addresses(upper - 1, arity), addresses(height - upper, arity)
    before, size = sum(map(len, top)), sum(map(len, below))
    roots = before + size * np.arange(arity**upper)
    return top + tuple((roots[:, None] + level).ravel() for level in below)


def block_height(n: int, spec: MerkleSpec) -> int:
    """Levels that a block rises: to one root where it holds a whole level of ``n`` nodes, else
    all levels, as the nodes beside it do."""
    height = 0
    while height < spec.height and spec.arity**height < n:
        height += 1
    return height


def build(leaves: list[bytes], height: int, arity: int) -> np.ndarray:
    """The nodes of a block in van Emde Boas order, 32 bytes each; absent ones are zero."""
    place = addresses(height, arity)
    nodes = np.zeros((sum(map(len, place)), 32), np.uint8)
    level = [x.hex() for x in leaves]
    for depth in range(height, -1, -1):
        digests = np.frombuffer(bytes.fromhex("".join(level)), np.uint8).reshape(-1, 32)
        nodes[place[depth][: len(level)]] = digests
        if depth:
            runs = range(0, len(level), arity)
            level = [sha256_hex("".join(level[i : i + arity])) for i in runs]
    return nodes


def levels(nodes: np.ndarray, n_leaves: int, height: int, arity: int) -> list[list[str]]:
    """The digests of a block level by level, from its leaves to below its root."""
    out = []
    for depth, place in zip(range(height, 0, -1), reversed(addresses(height, arity))):
        digits = nodes[place[:n_leaves]].tobytes().hex()
        out.append([digits[i : i + 64] for i in range(0, len(digits), 64)])
        n_leaves = -(-n_leaves // arity)
    return out


def siblings(block: list[list[str]], at: int, arity: int) -> Iterator[tuple[str, str]]:
    """Level by level what stands left and right of a leaf's ancestor (or itself) in its run."""
    for level in block:
        low = at - at % arity
        yield "".join(level[low:at]), "".join(level[at + 1 : low + arity])
        at //= arity


def pack(path: list[tuple[str, str]]) -> bytes:
    """A path as bytes: per level how many siblings stand left and right, then these."""
    return b"".join(
        bytes([len(a) // 64, len(z) // 64]) + bytes.fromhex(a + z) for a, z in path
    )


def unpack(path: bytes) -> list[tuple[str, str]]:
    out, at = [], 0
    while at < len(path):
        left, right = path[at] * 64, path[at + 1] * 64
        digits = path[at + 2 : at + 2 + (left + right) // 2].hex()
        out.append((digits[:left], digits[left:]))
        at += 2 + (left + right) // 2
    return out


def fold(leaf: str, path: list[tuple[str, str]]) -> str:
    """The root that a leaf and its siblings make."""
    for left, right in path:
        leaf = sha256_hex(left + leaf + right)
    return leaf


def leaf_digest(columns: dict[str, Column]) -> Column:
    """SHA-256 over the values, each ``-`` if NULL, else its length in bytes, ``:``, itself."""
    parts = []
    for value in columns.values():
        told = value.cast("string")
        size = F.octet_length(told).cast("string")
        parts.append(F.coalesce(F.concat(size, F.lit(":"), told), F.lit("-")))
    return F.unhex(F.sha2(F.concat(*parts), 256))


def _numbered(batches):
    """Rows of a slice come in order; ``at`` is a row's place among those of its key."""
    last, count = None, 0
    for batch in batches:
        keys, n = batch.column("key"), batch.num_rows
        if not n:
            continue
        new = np.ones(n, bool)
        new[1:] = pc.not_equal(keys[1:], keys[:-1]).to_numpy(zero_copy_only=False)
        at = np.arange(n)
        first = np.maximum.accumulate(np.where(new, at, 0))
        place = at - first
        if keys[0].as_py() == last:
            place[first == 0] += count
        last, count = keys[-1].as_py(), int(place[-1]) + 1
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(place)], names=[*batch.schema.names, "at"]
        )


def placed(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` with pos, the place (from 0) among the rows of the same ``key`` in ``order``, and
    n, the number of these.

    The order by key is cut into slices; rows are numbered inside a slice and shifted by the
    sizes of the key's slices before. No task holds more than a slice of a large key.
    """
    names = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    sliced = (
        rows.repartitionByRange("key", *order)
        .sortWithinPartitions("key", *order)
        .select("*", F.spark_partition_id().alias("slice"))
        .mapInArrow(_numbered, f"{names}, slice int, at bigint")
    )
    sliced = materialize(sliced, "sliced")
    own = Window.partitionBy("key")
    before = own.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sliced.groupBy("key", "slice").agg((F.max("at") + 1).alias("size"))
    sizes = sizes.select(
        "key",
        "slice",
        F.coalesce(F.sum("size").over(before), F.lit(0)).alias("shift"),
        F.sum("size").over(own).alias("n"),
    )
    moved = sliced.join(materialize(sizes, "sizes"), ["key", "slice"])
    return moved.withColumn("pos", F.col("shift") + F.col("at")).drop("slice", "at", "shift")


def _blocks(spec: MerkleSpec):
    """Rows come ordered by key and pos; each block becomes one row. The last block of a batch
    waits for the next batch, so that a task holds one batch and one block."""

    def built(rows: pa.Table, starts: list[int]) -> pa.RecordBatch:
        rows = rows.combine_chunks()
        node, n = rows.column("node").to_pylist(), rows.column("n").to_numpy()
        bounds = [*starts, len(node)]
        nodes = [
            build(node[a:z], block_height(n[a], spec), spec.arity).tobytes()
            for a, z in zip(bounds, bounds[1:])
        ]
        first = rows.take(pa.array(starts, pa.int64()))
        offsets = pa.array(bounds, pa.int32())
        listed = [
            pa.ListArray.from_arrays(offsets, rows.column(c).combine_chunks())
            for c in ("id", "other")
        ]
        plain = [first.column(c).combine_chunks() for c in ("key", "block", "n")]
        return pa.RecordBatch.from_arrays(
            [*plain, pa.array(nodes, pa.binary()), *listed],
            names=["key", "block", "n", "nodes", "ids", "others"],
        )

    def run(batches):
        waiting = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            rows = rows if waiting is None else pa.concat_tables([waiting, rows])
            if not rows.num_rows:
                continue
            key, block = (rows.column(c).combine_chunks() for c in ("key", "block"))
            same = pc.and_(pc.equal(key[1:], key[:-1]), pc.equal(block[1:], block[:-1]))
            new = np.flatnonzero(~same.to_numpy(zero_copy_only=False)) + 1
            starts = [0, *new.tolist()]
            if len(starts) > 1:
                yield built(rows.slice(0, starts[-1]), starts[:-1])
            waiting = rows.slice(starts[-1])
        if waiting is not None:
            yield built(waiting, [0])

    return run


def forest(entries: DataFrame, spec: MerkleSpec) -> list[DataFrame]:
    """The stored blocks of all trees, level by level.

    ``entries`` has key, pos, n, node, id, other: the leaves. The number of levels follows from
    the largest tree: with 729 leaves a block, three levels hold 387 million leaves.
    """
    out = []
    while True:
        block = F.floor(F.col("pos") / spec.leaves).alias("block")
        rows = entries.select("key", block, "pos", "n", "node", "id", "other")
        rows = rows.repartition("key", "block").sortWithinPartitions("key", "block", "pos")
        out.append(materialize(rows.mapInArrow(_blocks(spec), _BLOCK), f"blocks-{len(out)}"))
        above = out[-1].where(F.col("n") > spec.leaves)
        if above.isEmpty():
            return out
        entries = above.select(
            "key",
            F.col("block").alias("pos"),
            F.ceil(F.col("n") / spec.leaves).alias("n"),
            F.substring("nodes", 1, 32).alias("node"),
            F.lit(None).cast("bigint").alias("id"),
            F.lit(None).cast("binary").alias("other"),
        )


def tree_roots(blocks: list[DataFrame], spec: MerkleSpec) -> DataFrame:
    """(key, root) of every tree: the first node of the block that holds a whole level."""
    whole = [
        level.where(F.col("n") <= spec.leaves).select(
            "key", F.substring("nodes", 1, 32).alias("root")
        )
        for level in blocks
    ]
    return functools.reduce(DataFrame.unionAll, whole)


def _opened(batch: pa.RecordBatch, spec: MerkleSpec):
    """Per block: its leaves and its levels, and what each leaf needs of the path above."""
    columns = (batch.column(c).to_pylist() for c in ("block", "n", "nodes", "path"))
    for block, n, nodes, path in zip(*columns):
        height = block_height(n, spec)
        count = min(n - block * spec.leaves, spec.leaves)
        nodes = np.frombuffer(nodes, np.uint8).reshape(-1, 32)
        own = levels(nodes, count, height, spec.arity)
        leaves = own[0] if own else [nodes[0].tobytes().hex()]
        yield block, count, leaves, own, path


def _batches(rows: Iterator[tuple], schema: pa.Schema, size: int = 20_000):
    """Rows as record batches of about ``size``, however many blocks they come from."""
    while some := list(itertools.islice(rows, size)):
        arrays = [pa.array(c, f.type) for c, f in zip(zip(*some), schema)]
        yield pa.RecordBatch.from_arrays(arrays, schema=schema)


_PATH = pa.schema(
    [("key", pa.string()), ("block", pa.int64()), ("path", pa.binary()), ("subroot", pa.binary())]
)
_PROOF = pa.schema(
    [("id", pa.int64())]
    + [(c, pa.string()) for c in ("leaf", "subroot", "proof_sha256", "folded_root")]
    + [("siblings", pa.binary())]
)


def _paths_below(spec: MerkleSpec):
    """The path from each leaf of a block to the last root, for the block under that leaf."""

    def rows(batches):
        for batch in batches:
            keys, subroots = (batch.column(c).to_pylist() for c in ("key", "subroot"))
            for i, (block, count, _, own, path) in enumerate(_opened(batch, spec)):
                for at in range(count):
                    up = pack(list(siblings(own, at, spec.arity))) + path
                    yield keys[i], block * spec.leaves + at, up, subroots[i]

    return lambda batches: _batches(rows(batches), _PATH)


def _leaves(spec: MerkleSpec, with_siblings: bool):
    """Per leaf: itself, the digest of its siblings, and the root that its checked copy makes."""

    def rows(batches):
        for batch in batches:
            others, ids = (batch.column(c).to_pylist() for c in ("others", "ids"))
            subroots = batch.column("subroot").to_pylist()
            for i, (_, count, leaves, own, path) in enumerate(_opened(batch, spec)):
                upper, subroot = unpack(path), subroots[i].hex()
                above = "".join(a + z for a, z in upper)
                for at in range(count):
                    below = list(siblings(own, at, spec.arity))
                    told = "".join(a + z for a, z in below) + above
                    other = others[i][at]
                    copy = leaves[at] if other is None else other.hex()
                    root = fold(fold(copy, below), upper)
                    listed = bytes.fromhex(told) if with_siblings else None
                    yield ids[i][at], leaves[at], subroot, sha256_hex(told), root, listed

    return lambda batches: _batches(rows(batches), _PROOF)


def _known_paths(
    blocks: list[DataFrame], outer: DataFrame, last, schema: str, spec: MerkleSpec
) -> DataFrame:
    """From the top level down, each block with the path above it; ``last`` reads the lowest.

    ``outer`` (key, path, subroot) has the path from each tree's root on. A block that holds a
    whole level takes it; the other blocks get theirs from the level above.
    """
    below = None
    for i in range(len(blocks) - 1, -1, -1):
        level = blocks[i]
        whole = level.where(F.col("n") <= spec.leaves).select("key", "block")
        known = whole.join(outer, "key").select("key", "block", "path", "subroot")
        known = known if below is None else known.unionAll(below)
        opened = level.join(known, ["key", "block"])
        if i == 0:
            return opened.mapInArrow(last, schema)
        below = materialize(opened.mapInArrow(_paths_below(spec), _PATHS), f"paths-{i}")


@dataclass(frozen=True)
class Manifest:
    """``blocks``: the trees of the sources, ``sources``: the tree above them, level by level;
    both stored tables. ``root``: hexadecimal, None for an empty table."""

    blocks: list[DataFrame]
    sources: list[DataFrame]
    root: str | None
    spec: MerkleSpec


def manifest(
    docs: DataFrame,
    columns: tuple[str, ...] = COLUMNS,
    id_column: str = "doc_id",
    source_column: str = "source",
    checked: dict[str, Column] | None = None,
    spec: MerkleSpec | None = None,
) -> Manifest:
    """The trees over all rows of ``docs``. Texts are hashed by Spark and go no further.

    A row's leaf is the digest of ``columns``. Leaves of a source ascend by id (NULL first, a
    64-bit integer), and rows of the same id by digest, so repeated rows are leaves of their
    own. A NULL source is a source of its own, the first. ``checked`` replaces columns by what
    a later copy of the row holds: its digest is carried beside the leaf for ``proofs``.
    Long texts cost their hash only. Other columns of ``docs`` are not read.
    """
    spec = spec or MerkleSpec()
    ship_package(docs.sparkSession)
    held = {c: F.col(f"`{c}`") for c in columns}
    source = held.get(source_column, F.col(f"`{source_column}`")).cast("string")
    leaf = leaf_digest(held).alias("node")
    other = F.lit(None).cast("binary").alias("other")
    if checked:
        other = leaf_digest({c: checked.get(c, held[c]) for c in columns}).alias("other")
    key = F.coalesce(F.concat(F.lit("="), source), F.lit("")).alias("key")
    id_ = F.col(f"`{id_column}`").cast("bigint").alias("id")
    # The last column only lets a run of equal rows be cut; such rows are interchangeable.
    rows = docs.select(key, id_, leaf, other, F.monotonically_increasing_id().alias("tie"))
    blocks = forest(placed(rows, ["id", "node", "other", "tie"]).drop("tie"), spec)
    subroots = tree_roots(blocks, spec).select(
        F.lit("").alias("key"),
        F.col("key").alias("name"),
        F.lit(None).cast("bigint").alias("id"),
        F.col("root").alias("node"),
        F.col("key").cast("binary").alias("other"),
    )
    sources = forest(placed(subroots, ["name"]).drop("name"), spec)
    top = tree_roots(sources, spec).first()
    return Manifest(blocks, sources, None if top is None else bytes(top.root).hex(), spec)


def _source_paths(spec: MerkleSpec):
    """The path of each source's root in the tree of the sources; block 0 of its own tree."""

    def rows(batches):
        for batch in batches:
            names = batch.column("others").to_pylist()
            for i, (_, count, leaves, own, path) in enumerate(_opened(batch, spec)):
                for at in range(count):
                    up = pack(list(siblings(own, at, spec.arity))) + path
                    yield names[i][at].decode(), 0, up, bytes.fromhex(leaves[at])

    return lambda batches: _batches(rows(batches), _PATH)


def proofs(tree: Manifest, with_siblings: bool = False) -> DataFrame:
    """One row per leaf: id, leaf, subroot, proof_sha256 (digest of the siblings' digests from
    the leaf's run up to the last root, left to right), folded_root (from the checked copy of
    the row, or the leaf itself where none was given, and these siblings), and siblings (their
    digests, 32 bytes each, if asked for)."""
    spark, spec = tree.blocks[0].sparkSession, tree.spec
    top = spark.createDataFrame(
        [("", bytearray(), bytearray())], "key string, path binary, subroot binary"
    )
    outer = _known_paths(tree.sources, top, _source_paths(spec), _PATHS, spec)
    outer = materialize(outer.drop("block"), "sources")
    return _known_paths(tree.blocks, outer, _leaves(spec, with_siblings), _PROOFS, spec)


def without_newlines(text: Column, doc_id: Column) -> Column:
    """The tampering that the check looks for: line ends gone where crc32 of the id is even."""
    crc = F.crc32(doc_id.cast("string").cast("binary"))
    return F.when(crc % 2 == 0, F.replace(text, F.lit("\n"), F.lit(""))).otherwise(text)
