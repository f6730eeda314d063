"""Merkle manifest of a table with incremental witnesses.

Rows become leaves, the leaves of each group a tree of fixed arity, and the
groups' roots one more tree.  A tree is built by aligned appends: a node that
joins the open run of its level takes the digests before it as its partial
witness, and extends the witnesses of the nodes before it by its own digest.  A
full run closes into a subtree, which is appended one level up; so a leaf's
proof is its own witness and those of the subtrees that it lies in, and nothing
is gone over twice.

At scale, tasks append aligned blocks of ``arity ** 4`` leaves each.  The
blocks' roots are then appended in the same way, block by block, until one root
is left for each group, and so are the groups' roots.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import numbered, python_path, stored

BLOCK_LEVELS = 4
KEY = ("_named", "_group")  # a group that may be null; null comes first
#: One step of a proof: place among the run's nodes, digests (hex) of the others from left to right.
Step = tuple[int, list[bytes]]


def hashed(parts: Sequence[bytes]) -> bytes:
    return sha256(b"".join(parts)).hexdigest().encode()


class Node:
    __slots__ = ("digest", "above", "place", "witness")

    def __init__(self, digest: bytes) -> None:
        self.digest, self.above, self.place, self.witness = digest, None, 0, []

    def steps(self) -> list[Step]:
        """The steps to the root of the tree that this node was appended to."""
        out, node = [], self
        while node.above is not None:
            out.append((node.place, node.witness))
            node = node.above
        return out


class Appender:
    """Aligned appends to one tree of ``height`` levels over its leaves."""

    def __init__(self, arity: int, height: int) -> None:
        self.arity, self.runs, self.root = arity, [[] for _ in range(height)], None

    def append(self, node: Node, level: int = 0) -> None:
        if level == len(self.runs):
            if self.root is not None:
                raise ValueError("more leaves than the height allows")
            self.root = node
            return
        run = self.runs[level]
        node.place, node.witness = len(run), [other.digest for other in run]
        for other in run:
            other.witness.append(node.digest)
        run.append(node)
        if len(run) == self.arity:
            self._close(level)

    def _close(self, level: int) -> None:
        run, self.runs[level] = self.runs[level], []
        above = Node(hashed([node.digest for node in run]))
        for node in run:
            node.above = above
        self.append(above, level + 1)

    def finish(self) -> Node:
        """Close the open runs from below; the root."""
        for level in range(len(self.runs)):
            if self.runs[level]:
                self._close(level)
        return self.root


def height_of(n: int, arity: int) -> int:
    height = 0
    while n > 1:
        n, height = -(-n // arity), height + 1
    return height


def fold(digest: bytes, steps: Sequence[Step]) -> bytes:
    """The root that ``digest`` and the siblings of a proof give."""
    for place, others in steps:
        digest = hashed([*others[:place], digest, *others[place:]])
    return digest


def packed(steps: Sequence[Step]) -> bytes:
    """A proof as bytes: for each step its place, its number of siblings and their 32-byte digests."""
    return b"".join(bytes([place, len(others)]) + bytes.fromhex(b"".join(others).decode()) for place, others in steps)


def unpacked(raw: bytes) -> list[Step]:
    steps, at = [], 0
    while at < len(raw):
        place, n = raw[at], raw[at + 1]
        shown = raw[at + 2:at + 2 + 32 * n].hex().encode()
        steps.append((place, [shown[i:i + 64] for i in range(0, 64 * n, 64)]))
        at += 2 + 32 * n
    return steps


def leaf_digest(columns: Sequence[str | Column]) -> Column:
    """Digest of a row: each value as UTF-8 byte count, ``:`` and text, ``-`` for null."""
    def part(c: str | Column) -> Column:
        text = (F.col(f"`{c}`") if isinstance(c, str) else c).cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))
    return F.unhex(F.sha2(F.concat(*[part(c) for c in columns]), 256))


BLOCK_FIELDS = ("_named boolean, _group string, _block long, _height int, _total long, root binary, ids array<bigint>, "
                "leaves binary, candidates binary")


def _blocks(nodes: DataFrame, arity: int) -> DataFrame:
    """One row per aligned block of nodes (KEY, pos, total, id, leaf, candidate): its root and what it holds."""
    size = arity ** BLOCK_LEVELS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, tree, ids, leaves, candidates = None, None, [], [], []

        def done() -> pa.RecordBatch:
            named, group, block, total = key
            root = bytes.fromhex(tree.finish().digest.decode())
            values = (named, group, block, len(tree.runs), total, root, list(ids), b"".join(leaves), b"".join(candidates))
            return pa.RecordBatch.from_arrays(
                [pa.array([v], t) for v, t in zip(values, types, strict=True)], names=names)

        types = [pa.bool_(), pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.binary(), pa.binary()]
        names = ["_named", "_group", "_block", "_height", "_total", "root", "ids", "leaves", "candidates"]
        for batch in batches:
            for named, group, block, total, doc, leaf, candidate in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if key != (named, group, block, total):
                    if tree is not None:
                        yield done()
                    key, ids, leaves, candidates = (named, group, block, total), [], [], []
                    tree = Appender(arity, min(BLOCK_LEVELS, height_of(total, arity)))
                tree.append(Node(leaf.hex().encode()))
                ids.append(doc)
                leaves.append(leaf)
                candidates.append(candidate)
        if tree is not None:
            yield done()

    block = F.floor(F.col("pos") / F.lit(size)).cast("long")
    rows = nodes.withColumn("_block", block).repartition(*KEY, "_block").sortWithinPartitions(*KEY, "_block", "pos")
    return stored(rows.select(*KEY, "_block", "total", "id", "leaf", "candidate").mapInArrow(run, BLOCK_FIELDS), "merkle-blocks")


def _spread(blocks: DataFrame, above: DataFrame, arity: int, last: bool, with_path: bool = False) -> DataFrame:
    """The nodes of each block with their whole proofs, from ``above``: (KEY, pos, path, subroot, top) of the blocks' roots.

    ``subroot`` is null as long as the root of the block is the subroot itself.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in batch.to_pylist():
                tree, upper = Appender(arity, b["_height"]), unpacked(b["path"])
                digests = [b["leaves"][i:i + 32] for i in range(0, len(b["leaves"]), 32)]
                nodes = [Node(d.hex().encode()) for d in digests]
                for node in nodes:
                    tree.append(node)
                tree.finish()
                n = len(nodes)
                if not last:
                    first = b["_block"] * arity ** BLOCK_LEVELS
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([b["_named"]] * n), pa.array([b["_group"]] * n, pa.string()), pa.array(range(first, first + n), pa.int64()),
                         pa.array([packed(node.steps() + upper) for node in nodes], pa.binary()),
                         pa.array([b["subroot"]] * n, pa.string()), pa.array([b["top"]] * n, pa.string())],
                        names=["_named", "_group", "pos", "path", "subroot", "top"])
                    continue
                proofs, folded, paths = [], [], []
                for i, node in enumerate(nodes):
                    steps = node.steps() + upper
                    proofs.append(hashed([d for _, others in steps for d in others]).decode())
                    folded.append(fold(b["candidates"][32 * i:32 * i + 32].hex().encode(), steps).decode())
                    if with_path:
                        paths.append(packed(steps))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(b["ids"], pa.int64()), pa.array([node.digest.decode() for node in nodes]), pa.array([b["subroot"]] * n),
                     pa.array([b["top"]] * n), pa.array(proofs), pa.array(folded), *([pa.array(paths, pa.binary())] if with_path else [])],
                    names=["id", "leaf", "subroot", "root", "proof_sha256", "folded_root", *(["path"] if with_path else [])])

    up = above.withColumnRenamed("pos", "_block")
    joined = blocks.join(up, [*KEY, "_block"])
    columns = ["_named", "_group", "_block", "_height", "ids", "leaves", "candidates", "path", "subroot", "top"]
    fields = ("id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string" + ", path binary" * with_path
              if last else "_named boolean, _group string, pos long, path binary, subroot string, top string")
    return joined.select(*columns).mapInArrow(run, fields)


def _levels(nodes: DataFrame, arity: int) -> list[DataFrame]:
    """Blocks of the nodes, blocks of their roots, and so on until each group has one block."""
    levels, most = [], nodes.agg(F.max("total")).first()[0] or 0
    while True:
        blocks = _blocks(nodes, arity)
        levels.append(blocks)
        most = -(-most // arity ** BLOCK_LEVELS)
        if most <= 1:
            return levels
        total = F.ceil(F.col("_total") / F.lit(arity ** BLOCK_LEVELS)).cast("long")
        nodes = blocks.select(*KEY, F.col("_block").alias("pos"), total.alias("total"), F.col("_block").alias("id"),
                              F.col("root").alias("leaf"), F.col("root").alias("candidate"))


def manifest(docs: DataFrame, columns: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"),
             group: str = "lang", order: str = "doc_id", candidate: Column | None = None, arity: int = 8,
             with_path: bool = False) -> DataFrame:
    """One row per row of ``docs``: id, leaf, subroot, root, proof_sha256, folded_root.

    ``leaf`` is the digest of ``columns``; the leaves of each ``group`` ascend
    by ``order`` (an integer column).  While a group has several nodes, every
    ``arity`` consecutive ones become the digest of their digests, the last run
    also if it holds one alone; what is left is the group's ``subroot``.  The
    subroots, by group, give the ``root`` in the same way.  ``proof_sha256`` is
    the digest of the siblings on the way to the root, and ``folded_root`` the
    root recomputed from ``candidate`` (a digest column such as ``leaf_digest``
    gives for a row as received; the own leaf where it is null or not given)
    and those siblings: it equals ``root`` if the row is unchanged.
    ``with_path`` adds ``path``, the proof itself (``unpacked`` reads it).

    Nulls count as values: they have a digest of their own, rows of a null
    group form a group that comes first, and rows without an order come first
    in their group.  Rows that share an order follow one another by leaf; rows
    that repeat in full are leaves of their own.  A lone leaf is its group's
    subroot, a lone subroot the root.  An empty table gives no rows.  Columns
    not named are not read, whatever their names.
    """
    python_path(docs.sparkSession)
    own = leaf_digest(columns)
    rows = stored(docs.select(F.col(group).isNotNull().alias("_named"), F.coalesce(F.col(group).cast("string"), F.lit("")).alias("_group"),
                              F.col(order).cast("long").alias("id"), own.alias("leaf"),
                              (own if candidate is None else F.coalesce(candidate, own)).alias("candidate")), "merkle-leaves")
    levels = _levels(numbered(rows, KEY, ["id", "leaf", "candidate"]), arity)
    # the groups' roots are appended to one more tree, in the order of the groups
    tops = levels[-1].select(F.lit(True).alias("_named"), F.lit("").alias("_group"), F.struct(*KEY).alias("_of"),
                             F.col("root").alias("leaf"), F.lit(0).cast("long").alias("id"), F.col("root").alias("candidate"))
    tops = stored(numbered(tops, KEY, ["_of"]), "merkle-groups")
    group_levels = _levels(tops, arity)
    above = group_levels[-1].select(*KEY, F.lit(0).cast("long").alias("pos"), F.lit(b"").alias("path"),
                                    F.lit(None).cast("string").alias("subroot"), F.lower(F.hex("root")).alias("top"))
    for blocks in reversed(group_levels):
        above = stored(_spread(blocks, above, arity, last=False), "merkle-paths")
    above = (tops.select("_of", "pos", F.lower(F.hex("leaf")).alias("_root")).join(above, "pos")
             .select("_of.*", F.lit(0).cast("long").alias("pos"), "path", F.col("_root").alias("subroot"), "top"))
    for blocks in reversed(levels[1:]):
        above = stored(_spread(blocks, above, arity, last=False), "merkle-paths")
    return _spread(levels[0], above, arity, last=True, with_path=with_path)
