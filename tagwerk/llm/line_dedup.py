"""Line dedup with a sharded minimal perfect hash.

The lines that many documents hold are known by 128-bit hashes.  Each shard of
these hashes gets a minimal perfect hash: levels of bit arrays in which a key
takes the first place that no other key of its level takes, so the number of
set bits before its own is its index, without gaps and without stored keys.
The index leads to compact arrays: a 64-bit fingerprint, which tells lines of
the shard from any other, the number of documents, and the document that keeps
the line.  Documents probe these arrays while they are read; no line is joined.

The arrays take about 20 bytes a common line.  Up to ``most_bytes`` of them
(measured, not guessed) go to every task, which then reads, probes and writes
its documents in one pass without a shuffle.  Beyond that the same arrays stay
with their shards and the documents' line hashes travel to them.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import python_path, stored

KEYS_A_SHARD = 1 << 16
ENTRY_BYTES = 21          # fingerprint 8, count 4, last document 8, bits of the levels
PROBES_A_TASK = 1_000_000
_ODD = np.uint64(0x9E3779B97F4A7C15)  # 2^64 / golden ratio


def _mixed(hi: np.ndarray, lo: np.ndarray, level: int) -> np.ndarray:
    x = lo ^ (hi + np.uint64(level + 1)) * _ODD
    x ^= x >> np.uint64(32)
    x *= _ODD
    x ^= x >> np.uint64(29)
    return x


@dataclass
class LineTable:
    """One shard: levels of the hash, and the arrays that its index leads to."""

    sizes: list[int]      # places of each level
    words: np.ndarray     # bits of all levels, 64 a word
    prints: np.ndarray    # fingerprint, uint64
    counts: np.ndarray    # documents, uint32
    last: np.ndarray      # the document that keeps the line, int64

    def __post_init__(self) -> None:
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)])

    @classmethod
    def build(cls, hi: np.ndarray, lo: np.ndarray, counts: np.ndarray, last: np.ndarray, room: float = 1.7) -> LineTable:
        """Of distinct keys (hi, lo)."""
        left, sizes, levels = np.arange(len(hi)), [], []
        while len(left):
            size = -(-int(room * len(left) + 64) // 64) * 64
            place = (_mixed(hi[left], lo[left], len(sizes)) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(place, minlength=size) == 1
            levels.append(np.packbits(alone, bitorder="little").view(np.uint64))
            sizes.append(size)
            left = left[~alone[place]]
        none = np.zeros(0, np.uint64)
        table = cls(sizes, np.concatenate(levels) if levels else none, none, none, none)
        order = np.empty(len(hi), np.int64)
        order[table.index(hi, lo)] = np.arange(len(hi))
        return cls(sizes, table.words, hi[order], np.minimum(counts[order], 0xFFFFFFFF).astype(np.uint32), last[order])

    def index(self, hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
        """Index of each key; -1 or that of another key if it is not in the table."""
        out, left, base = np.full(len(hi), -1, np.int64), np.arange(len(hi)), 0
        for level, size in enumerate(self.sizes):
            if not len(left):
                break
            place = (_mixed(hi[left], lo[left], level) % np.uint64(size)).astype(np.int64) + base
            word, bit = self.words[place >> 6], (place & 63).astype(np.uint64)
            there = (word >> bit & np.uint64(1)).astype(bool)
            below = np.bitwise_count(word & ((np.uint64(1) << bit) - np.uint64(1)))
            out[left[there]] = (self.before[place >> 6] + below)[there]
            left, base = left[~there], base + size
        return out

    def probe(self, hi: np.ndarray, lo: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Documents that hold each line (0 if it is not in the table) and the one that keeps it."""
        if not len(self.prints):
            return np.zeros(len(hi), np.uint32), np.zeros(len(hi), np.int64)
        at = self.index(hi, lo)
        found = (at >= 0) & (self.prints[at] == hi)
        return np.where(found, self.counts[at], 0).astype(np.uint32), np.where(found, self.last[at], 0)

    def row(self) -> dict:
        return {"sizes": self.sizes, "words": self.words.tobytes(), "prints": self.prints.tobytes(),
                "counts": self.counts.tobytes(), "last": self.last.tobytes()}

    @classmethod
    def of(cls, row: dict) -> LineTable:
        return cls(list(row["sizes"]), *(np.frombuffer(row[name], kind) for name, kind in
                                         (("words", "<u8"), ("prints", "<u8"), ("counts", "<u4"), ("last", "<i8"))))


TABLE_FIELDS = "sizes array<bigint>, words binary, prints binary, counts binary, last binary"


def keyed_lines(raw: bytes, shortest: int) -> list[tuple[int, bytes]]:
    """(number, 128-bit hash) of the lines whose key has at least ``shortest`` characters.

    A key is the line without ASCII white space at both ends, A-Z lower-cased.
    """
    out = []
    for number, line in enumerate(raw.split(b"\n")):
        if len(line) >= shortest:
            key = line.strip().lower()  # of bytes: ASCII only
            if len(key) >= shortest and (key.isascii() or len(key.decode("utf-8", "surrogatepass")) >= shortest):
                out.append((number, xxhash.xxh3_128_digest(key)))
    return out


def _halves(digests: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    pair = np.frombuffer(b"".join(digests), ">u8").reshape(-1, 2).astype(np.uint64)
    return pair[:, 0].copy(), pair[:, 1].copy()


def _texts(docs: DataFrame, *columns) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text"), *columns)


def common_lines(docs: DataFrame, shortest: int, least_docs: int) -> DataFrame:
    """(hi, lo, n, last): hash of each line found in at least ``least_docs`` documents, their number, the largest doc_id."""
    python_path(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests, ids = [], []

            def take() -> pa.RecordBatch:
                hi, lo = _halves(digests)
                rows = pa.RecordBatch.from_arrays([pa.array(hi.view(np.int64)), pa.array(lo.view(np.int64)), pa.array(ids, pa.int64())],
                                                  names=["hi", "lo", "doc_id"])
                digests.clear()
                ids.clear()
                return rows

            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                own = {digest for _, digest in keyed_lines(text.as_py() or b"", shortest)}
                digests.extend(own)
                ids.extend([doc_id] * len(own))
                if len(digests) > 100_000:
                    yield take()
            if digests:
                yield take()

    lines = _texts(docs).mapInArrow(run, "hi long, lo long, doc_id long")
    return (lines.distinct().groupBy("hi", "lo").agg(F.count(F.lit(1)).alias("n"), F.max("doc_id").alias("last"))
            .where(F.col("n") >= least_docs))


def _shard(lo: np.ndarray, shards: int) -> np.ndarray:
    return (lo % np.uint64(shards)).astype(np.int64)


def line_tables(common: DataFrame, shards: int) -> DataFrame:
    """(shard, load, table): one row a shard; ``load`` is the number of (line, document) pairs that meet there."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def done() -> pa.RecordBatch:
            rows = pa.Table.from_batches(held)
            hi, lo, n, last = (rows.column(c).to_numpy() for c in ("hi", "lo", "n", "last"))
            table = LineTable.build(hi.view(np.uint64), lo.view(np.uint64), n, last).row()
            out = pa.RecordBatch.from_pydict({
                "shard": pa.array([rows.column("shard")[0].as_py()], pa.int64()), "load": pa.array([int(n.sum())], pa.int64()),
                "sizes": pa.array([table["sizes"]], pa.list_(pa.int64())), **{k: pa.array([table[k]], pa.binary()) for k in ("words", "prints", "counts", "last")}})
            held.clear()
            return out

        for batch in batches:
            shard = batch.column(0).to_numpy()
            edges = [0, *(np.flatnonzero(np.diff(shard)) + 1).tolist(), len(shard)]
            for a, b in zip(edges, edges[1:], strict=False):
                if b > a:
                    if held and held[0].column(0)[0].as_py() != shard[a]:
                        yield done()
                    held.append(batch.slice(a, b - a))
        if held:
            yield done()

    # as in _shard: the unsigned remainder
    shard = F.pmod(F.pmod(F.col("lo"), F.lit(shards)) + F.when(F.col("lo") < 0, F.lit(2 ** 64 % shards)).otherwise(F.lit(0)), F.lit(shards))
    dealt = common.select(shard.cast("long").alias("shard"), "hi", "lo", "n", "last").repartition("shard").sortWithinPartitions("shard")
    return dealt.mapInArrow(run, "shard long, load long, " + TABLE_FIELDS)


FOUND_FIELDS = "doc_id long, n_lines long, n_dropped long, kept_sha256 string, text string"


def _cleaned(raw: bytes, gone: set[int], digest_only: bool) -> tuple[int, int, str, str | None]:
    """n_lines, n_dropped, digest of what is kept, what is kept."""
    n = raw.count(b"\n") + 1
    if gone:
        raw = b"\n".join([line for i, line in enumerate(raw.split(b"\n")) if i not in gone])
    return n, len(gone), sha256(raw).hexdigest(), None if digest_only else raw.decode("utf-8", "surrogatepass")


def _batch(rows: list[tuple], kept: list[pa.Array], names: Sequence[str]) -> pa.RecordBatch:
    ids, n, dropped, digests, texts = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(n, pa.int64()), pa.array(dropped, pa.int64()), pa.array(digests),
                                       pa.array(texts, pa.string()), *kept],
                                      names=["doc_id", "n_lines", "n_dropped", "kept_sha256", "text", *names])


def _drop_local(docs: DataFrame, tables: DataFrame, shards: int, shortest: int, digest_only: bool, keep: Sequence[str]) -> DataFrame:
    """Every task has all tables: their measured size is within the bound."""
    rows = {row["shard"]: row.asDict() for row in tables.drop("load").collect()}
    sent = docs.sparkSession.sparkContext.broadcast(rows)
    fields = FOUND_FIELDS + "".join(f", `_kept{i}` {docs.schema[c].dataType.simpleString()}" for i, c in enumerate(keep))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = {shard: LineTable.of(row) for shard, row in sent.value.items()}
        for batch in batches:
            for part in _slices(batch):
                ids, raws = part.column(0).to_pylist(), [t.as_py() or b"" for t in part.column(1)]
                lines = [(row, number, digest) for row, raw in enumerate(raws) for number, digest in keyed_lines(raw, shortest)]
                gone: list[set[int]] = [set() for _ in raws]
                if lines and own:
                    hi, lo = _halves([digest for _, _, digest in lines])
                    shard = _shard(lo, shards)
                    order = np.argsort(shard, kind="stable")
                    edges = np.searchsorted(shard[order], np.arange(shards + 1))
                    for s, table in own.items():
                        mine = order[edges[s]:edges[s + 1]]
                        n, last = table.probe(hi[mine], lo[mine])
                        for i, keeper in zip(mine[n > 0].tolist(), last[n > 0].tolist(), strict=True):
                            if ids[lines[i][0]] != keeper:
                                gone[lines[i][0]].add(lines[i][1])
                found = [(doc_id, *_cleaned(raw, g, digest_only)) for doc_id, raw, g in zip(ids, raws, gone, strict=True)]
                yield _batch(found, part.columns[2:], [f"_kept{i}" for i in range(len(keep))])

    return _texts(docs, *[F.col(f"`{c}`").alias(f"_kept{i}") for i, c in enumerate(keep)]).mapInArrow(run, fields)


def _slices(batch: pa.RecordBatch, most: int = 16 << 20) -> Iterator[pa.RecordBatch]:
    """Parts of about ``most`` bytes of text."""
    part = np.cumsum(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False), dtype=np.int64) // most
    edges = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    for a, b in zip(edges, edges[1:], strict=False):
        if b > a:
            yield batch.slice(a, b - a)


def _drop_routed(docs: DataFrame, tables: DataFrame, shards: int, shortest: int, digest_only: bool, keep: Sequence[str]) -> DataFrame:
    """Line hashes travel to the shard that holds their table, and the numbers of dropped lines back.

    Which lines a row loses depends on its id and text alone, so a row is named
    by its id and a hash of its text.  A shard that meets more than its share
    of pairs is dealt to several tasks, each with the table.
    """
    spark = docs.sparkSession
    tables = stored(tables, "line-tables")
    share = max(PROBES_A_TASK, (tables.agg(F.sum("load")).first()[0] or 0) // 10_000)
    copies = {row["shard"]: 1 + row["load"] // share for row in tables.where(F.col("load") >= share).select("shard", "load").collect()}
    named = (F.xxhash64("text"), F.xxhash64(F.lit(1), "text"))

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _slices(batch):
                names = list(zip(*(part.column(i).to_pylist() for i in (0, 2, 3)), strict=True))
                found = [(row, number, digest) for row, t in enumerate(part.column(1)) for number, digest in keyed_lines(t.as_py() or b"", shortest)]
                if not found:
                    continue
                hi, lo = _halves([digest for _, _, digest in found])
                shard, number = _shard(lo, shards), np.array([n for _, n, _ in found], np.int32)
                ids, t1, t2 = zip(*(names[row] for row, _, _ in found), strict=True)
                turn = [(a ^ n) % copies.get(s, 1) for a, n, s in zip(t1, number.tolist(), shard.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(shard), pa.array(turn, pa.int64()), pa.array(hi.view(np.int64)), pa.array(lo.view(np.int64)),
                     pa.array(ids, pa.int64()), pa.array(t1, pa.int64()), pa.array(t2, pa.int64()), pa.array(number)],
                    names=["shard", "turn", "hi", "lo", "doc_id", "t1", "t2", "number"])

    line_fields = "shard long, turn long, hi long, lo long, doc_id long, t1 long, t2 long, number int"
    probes = _texts(docs, named[0].alias("t1"), named[1].alias("t2")).mapInArrow(lines, line_fields)
    turns = F.array(F.lit(0).cast("long")) if not copies else F.sequence(F.lit(0).cast("long"), F.coalesce(
        F.element_at(F.create_map(*[F.lit(x) for pair in copies.items() for x in pair]), F.col("shard")), F.lit(1)).cast("long") - 1)
    arrays = tables.select("shard", F.explode(turns).alias("turn"), F.struct("sizes", "words", "prints", "counts", "last").alias("table"))
    mixed = probes.withColumn("table", F.lit(None).cast(arrays.schema["table"].dataType)).unionByName(arrays, allowMissingColumns=True)

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, own = None, None
        for batch in batches:
            cells = [batch.column(i) for i in range(9)]
            at = np.stack([cells[0].to_numpy(), cells[1].to_numpy()])
            edges = [0, *(np.flatnonzero((np.diff(at) != 0).any(axis=0)) + 1).tolist(), batch.num_rows]
            for a, b in zip(edges, edges[1:], strict=False):
                if b <= a:
                    continue
                if key != (at[0, a], at[1, a]):
                    key, own = (at[0, a], at[1, a]), None
                if cells[8][a].is_valid:  # the table comes first in its group
                    own, a = LineTable.of(cells[8][a].as_py()), a + 1
                if own is None or b <= a:
                    continue
                hi, lo = (cells[i].slice(a, b - a).to_numpy().view(np.uint64) for i in (2, 3))
                n, last = own.probe(hi, lo)
                ids = cells[4].slice(a, b - a)
                other = pc.fill_null(pc.not_equal(ids, pa.array(last, pa.int64())), True).to_numpy(zero_copy_only=False)
                hit = pa.array((n > 0) & other)
                yield pa.RecordBatch.from_arrays([cells[i].slice(a, b - a).filter(hit) for i in (4, 5, 6, 7)], names=["doc_id", "t1", "t2", "number"])

    first = F.col("table").isNull()
    hits = (mixed.repartition("shard", "turn").sortWithinPartitions("shard", "turn", first)
            .select("shard", "turn", "hi", "lo", "doc_id", "t1", "t2", "number", "table")
            .mapInArrow(probe, "doc_id long, t1 long, t2 long, number int"))
    name = [F.col("doc_id").isNull(), F.coalesce("doc_id", F.lit(0)), "t1", "t2"]
    hits = hits.select(name[0].alias("_u"), name[1].alias("_i"), F.col("t1").alias("_t1"), F.col("t2").alias("_t2"), "number")
    # stored, so that the join has a plain exchange on both sides and rows that repeat very often are split
    gone = stored(hits.groupBy("_u", "_i", "_t1", "_t2").agg(F.collect_set("number").alias("gone")), "line-hits")
    kept = [F.col(f"`{c}`").alias(f"_kept{i}") for i, c in enumerate(keep)]
    rows = _texts(docs, named[0].alias("_t1"), named[1].alias("_t2"), *kept)
    rows = rows.select("*", F.col("doc_id").isNull().alias("_u"), F.coalesce("doc_id", F.lit(0)).alias("_i"))
    fields = FOUND_FIELDS + "".join(f", `_kept{i}` {docs.schema[c].dataType.simpleString()}" for i, c in enumerate(keep))

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _slices(batch):
                found = [(doc_id, *_cleaned(t.as_py() or b"", set(g.as_py() or ()), digest_only)) for doc_id, t, g in
                         zip(part.column(0).to_pylist(), part.column(1), part.column(2), strict=True)]
                yield _batch(found, part.columns[3:], [f"_kept{i}" for i in range(len(keep))])

    python_path(spark)
    return (rows.join(gone, ["_u", "_i", "_t1", "_t2"], "left").select("doc_id", "text", "gone", *[f"_kept{i}" for i in range(len(keep))])
            .mapInArrow(finish, fields))


def without_common_lines(docs: DataFrame, shortest: int = 40, least_docs: int = 5, digest_only: bool = False,
                         keep: Sequence[str] = (), most_bytes: int = 64 << 20) -> DataFrame:
    """One row per row: doc_id, n_lines, n_dropped, kept_sha256, text, and the columns ``keep`` as they are.

    Texts are cut at line feeds.  Lines whose key (see ``keyed_lines``) has at
    least ``shortest`` characters and is found in at least ``least_docs``
    documents go, all of a document's, except from the document of the largest
    doc_id that holds it; what stays is joined by line feeds into ``text``
    (null with ``digest_only``, where its SHA-256 alone is wanted).

    Null and empty texts are one empty line.  A line that a document repeats
    counts once.  Rows that share a doc_id are one document, and so are all
    rows without one, which is smaller than any other; if the largest doc_id
    is in several rows, all of them keep the line.  An empty table gives no
    rows.  Columns that are not named are not read; a kept column of the name
    of a result column is refused.
    """
    clash = {"doc_id", "n_lines", "n_dropped", "kept_sha256", "text"} & set(keep)
    if clash:
        raise ValueError(f"result columns cannot be kept beside: {sorted(clash)}")
    common = stored(common_lines(docs, shortest, least_docs), "common-lines")
    n = common.count()
    shards = max(1, -(-n // KEYS_A_SHARD))
    drop = _drop_local if n * ENTRY_BYTES <= most_bytes else _drop_routed
    found = drop(docs, line_tables(common, shards), shards, shortest, digest_only, keep)
    return found.withColumnsRenamed({f"_kept{i}": c for i, c in enumerate(keep)})
