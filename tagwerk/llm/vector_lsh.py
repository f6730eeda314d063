"""Embedding near-duplicates by Euclidean p-stable hashing.

Vectors are scaled to length one, so cosine c is distance sqrt(2 - 2 c).  Each
of ``tables`` hash tables buckets a vector by ``width`` quantised random
projections floor((a . v + b) / w), a with normal entries.  Vectors that share
a bucket are checked by their exact cosine in double precision.

With the defaults a pair at cosine 0.95 meets in some table with probability
0.995, at 0.97 with 0.9999, while unrelated vectors share a bucket in about
4e-6 of the cases per table.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import connected_components, python_path, stored

SMALL = 32  # buckets up to this size are compared by shifts over all buckets at once
FOUND = "id long, n long, other long"


@lru_cache(maxsize=4)
def _family(dim: int, tables: int, width: int, w: float, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    rng = np.random.default_rng([seed, dim])
    return (rng.standard_normal((dim, tables * width)), rng.uniform(0, w, tables * width),
            rng.integers(0, 1 << 63, (tables, width), dtype=np.uint64) | np.uint64(1))


def bucket_keys(unit: np.ndarray, tables: int, width: int, w: float, seed: int) -> np.ndarray:
    """32-bit bucket key of each row of ``unit`` (vectors of length one) in each table."""
    a, b, mix = _family(unit.shape[1], tables, width, w, seed)
    cells = np.floor((unit @ a + b) / w).astype(np.int64).astype(np.uint64).reshape(len(unit), tables, width)
    return ((cells * mix).sum(axis=2, dtype=np.uint64) >> np.uint64(32)).astype(np.uint32).view(np.int32)


def _unit(vecs: np.ndarray) -> np.ndarray:
    v = vecs.astype(np.float64)
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def _components(near: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """The smallest id each row reaches over the square boolean matrix ``near`` (diagonal set)."""
    low = ids
    while True:
        new = np.where(near, low[None, :], np.iinfo(np.int64).max).min(axis=1)
        if (new == low).all():
            return low
        low = new


class _Buckets:
    """Compares the rows of a run of whole buckets; emits (id, n, other)."""

    def __init__(self, cosine: float) -> None:
        self.cosine, self.out = cosine, []

    def emit(self, ids: np.ndarray, n: np.ndarray, other: np.ndarray) -> None:
        use = (n > 0) | (other >= 0)
        if use.any():
            self.out.append((ids[use], n[use], other[use]))

    def small(self, group: np.ndarray, table: np.ndarray, ids: np.ndarray, copies: np.ndarray,
              unit: np.ndarray, keys: np.ndarray) -> None:
        """All buckets of up to SMALL rows together: row i against row i + d."""
        tables = np.arange(keys.shape[1])
        for d in range(1, SMALL):
            i = np.flatnonzero(group[:-d] == group[d:]) if len(group) > d else np.zeros(0, int)
            if not len(i):
                break
            j = i + d
            met = ((keys[i] == keys[j]) & (tables[None, :] < table[i][:, None])).any(axis=1)  # in an earlier table
            near = ~met & (np.einsum("ij,ij->i", unit[i], unit[j]) >= self.cosine)
            i, j = i[near], j[near]
            self.emit(ids[i], copies[j], ids[j])
            self.emit(ids[j], copies[i], np.full(len(j), -1))

    def large(self, table: int, side: np.ndarray, ids: np.ndarray, copies: np.ndarray,
              unit: np.ndarray, keys: np.ndarray) -> None:
        """One pair of blocks of a large bucket, or one block against itself."""
        two = side[0] != side[-1]
        a = np.flatnonzero(side == side[0])
        b = np.flatnonzero(side == side[-1]) if two else a
        near = unit[a] @ unit[b].T >= self.cosine
        if not two:
            near |= np.eye(len(a), dtype=bool)
        if two:
            square = np.eye(len(a) + len(b), dtype=bool)
            square[: len(a), len(a):], square[len(a):, : len(a)] = near, near.T
            rows = np.concatenate([a, b])
        else:
            square, rows = near | near.T, a
        self.emit(ids[rows], np.zeros(len(rows), np.int64), _components(square, ids[rows]))
        fresh = near.copy()
        for t in range(table):
            fresh &= keys[a, t][:, None] != keys[b, t][None, :]
        if not two:
            np.fill_diagonal(fresh, False)
        self.emit(ids[a], fresh @ copies[b], np.full(len(a), -1))
        if two:
            self.emit(ids[b], fresh.T @ copies[a], np.full(len(b), -1))

    def take(self) -> pa.RecordBatch:
        ids, n, other = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (zip(*self.out, strict=True) if self.out else ((), (), ())))
        self.out = []
        return pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(n, pa.int64()), pa.array(other, pa.int64(), mask=other < 0)],
            names=["id", "n", "other"])


def near_vectors(vectors: DataFrame, cosine: float = 0.95, tables: int = 56, width: int = 14,
                 w: float = 1.6, block: int = 1024, seed: int = 11) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept.

    ``vectors``: vec_id (not negative), embedding (array of numbers).  Equal
    vectors are one class from the start, however many there are, and links are
    found between classes.  Buckets of more than ``block`` classes are split
    into blocks and every pair of blocks is a task of its own, so a crowded
    bucket is neither cut short nor held in one task.  A pair counts in the
    first table in which it meets, so no pair counts twice and no pair is
    written out for crowded buckets: they emit counts and spanning links.

    Vectors that are null, empty, zero or hold null or non-finite components
    link with nothing; vectors of different length never link.  Rows that share
    a vec_id are copies in their own right, each with a row.  A null vec_id
    gives a row without component and links nothing.  An empty table gives no
    rows; other columns are not read.
    """
    spark = vectors.sparkSession
    python_path(spark)
    kind = dict(vectors.dtypes)["embedding"]
    kind = kind if kind == "array<float>" else "array<double>"
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast(kind).alias("vec"))
    bad = F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    nonzero = F.exists("vec", lambda x: x != 0)
    usable = F.col("vec_id").isNotNull() & F.coalesce(~bad & nonzero, F.lit(False))
    # one row per distinct vector; partial sums run before the shuffle
    classes = (rows.where(usable).groupBy("vec").agg(F.min("vec_id").alias("first_id"), F.count(F.lit(1)).alias("copies"))
               .select(F.monotonically_increasing_id().alias("id"), "first_id", "copies", "vec"))

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = np.diff(batch.column(3).offsets.to_numpy())
            flat = batch.column(3).flatten().to_numpy(zero_copy_only=False)
            ends = np.cumsum(dims)
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                keys = bucket_keys(_unit(flat[(ends[at] - dim)[:, None] + np.arange(dim)]), tables, width, w, seed)
                lists = pa.ListArray.from_arrays(np.arange(len(at) + 1, dtype=np.int32) * tables, keys.ravel())
                yield pa.RecordBatch.from_arrays([*(c.take(pa.array(at)) for c in batch.columns), lists],
                                                 names=["id", "first_id", "copies", "vec", "keys"])

    kept = stored(classes.mapInArrow(keyed, f"id long, first_id long, copies long, vec {kind}, keys array<int>"), "lsh-keys")
    slim = kept.select("id", F.size("vec").alias("dim"), F.posexplode("keys").alias("t", "key"))
    crowd = slim.groupBy("t", "key", "dim").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    blocks = F.ceil(F.col("size") / block).cast("int")
    own = F.pmod(F.xxhash64("id"), blocks).cast("int")
    tasks = (slim.join(crowd, ["t", "key", "dim"]).withColumn("blocks", blocks).withColumn("side", own)
             .withColumn("mate", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("id", "t", "key", "dim", "side", F.least("side", "mate").alias("x"), F.greatest("side", "mate").alias("y")))
    loaded = tasks.join(kept, "id")
    columns = ["t", "key", "dim", "x", "y", "side", "id", "copies", "vec", "keys"]
    dealt = (loaded.select(*columns).repartition("t", "key", "dim", "x", "y")
             .sortWithinPartitions("t", "key", "dim", "x", "y", "side", "id"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = _Buckets(cosine)

        def whole(tab: pa.Table) -> Iterator[pa.RecordBatch]:
            """``tab`` holds whole tasks."""
            tab = tab.combine_chunks()
            head = np.stack([tab.column(c).to_numpy().astype(np.int64) for c in columns[:5]])
            new = np.flatnonzero((head[:, 1:] != head[:, :-1]).any(axis=0)) + 1
            starts, stops = np.append(0, new), np.append(new, len(tab))
            side, ids, copies = (tab.column(c).to_numpy() for c in ("side", "id", "copies"))
            group = np.repeat(np.arange(len(starts)), stops - starts)
            vec, keys = tab.column("vec").chunk(0), tab.column("keys").chunk(0)
            size = stops - starts
            few = (size[group] <= SMALL) & (head[3] == 0) & (head[4] == 0)
            for dim in np.unique(head[2][few]):
                at = np.flatnonzero(few & (head[2] == dim))
                for i in range(0, len(at), 1 << 15):  # a run that may cut a bucket is widened to its end
                    j = min(len(at), i + (1 << 15))
                    lo = i if i == 0 else int(np.searchsorted(group[at], group[at[i]], "right" if group[at[i]] == group[at[i - 1]] else "left"))
                    hi = j if j == len(at) else int(np.searchsorted(group[at], group[at[j - 1]], "right"))
                    rows_at = at[lo:hi]
                    if len(rows_at):
                        work.small(group[rows_at], head[0][rows_at], ids[rows_at], copies[rows_at],
                                   _unit(_matrix(vec, rows_at, dim)), _matrix(keys, rows_at, tables))
            yield work.take()
            for g in np.flatnonzero(~((size <= SMALL) & (head[3][starts] == 0) & (head[4][starts] == 0))):
                at = np.arange(starts[g], stops[g])
                if side[at[0]] == side[at[-1]] and head[3][at[0]] != head[4][at[0]]:
                    continue  # the other block is empty
                work.large(int(head[0][at[0]]), side[at], ids[at], copies[at],
                           _unit(_matrix(vec, at, int(head[2][at[0]]))), _matrix(keys, at, tables))
                yield work.take()

        rest = None
        for batch in batches:
            tab = pa.Table.from_batches([batch])
            tab = tab if rest is None else pa.concat_tables([rest, tab])
            last = [tab.column(c)[-1].as_py() for c in columns[:5]]
            at = len(tab) - 1
            tail = np.ones(len(tab), bool)
            for c, v in zip(columns[:5], last, strict=True):
                tail &= tab.column(c).to_numpy() == v
            at = len(tab) - int(tail[::-1].cumprod().sum())
            if at:
                yield from whole(tab.slice(0, at))
            rest = tab.slice(at)
        if rest is not None and len(rest):
            yield from whole(rest)

    found = stored(dealt.mapInArrow(compare, FOUND), "lsh-links")
    counts = found.groupBy("id").agg(F.sum("n").alias("near"))
    joined = connected_components(found.where("other is not null").select(F.col("id").alias("u"), F.col("other").alias("v")))
    named = joined.withColumnRenamed("node", "id").join(kept.select("id", "first_id"), "id")
    names = named.groupBy("component").agg(F.min("first_id").alias("name"))
    # stored, so that the last join has a plain exchange on both sides and a hot vector is split
    labelled = stored(kept.select("id", "first_id", "copies", "vec").join(counts, "id", "left")
                      .join(named.join(names, "component").select("id", "name"), "id", "left")
                      .select("vec", (F.col("copies") - 1 + F.coalesce("near", F.lit(0))).alias("links"),
                              F.coalesce("name", "first_id").alias("class")), "lsh-names")
    good = rows.where(usable).join(labelled, "vec").select("vec_id", "links", "class")
    lone = rows.where(~usable).select("vec_id", F.lit(0).cast("long").alias("links"), F.col("vec_id").alias("class"))
    return good.unionByName(lone).select("vec_id", F.col("links").alias("n_links"), F.col("class").alias("component_id"),
                                         (F.col("vec_id") == F.col("class")).alias("kept"))


def _matrix(lists: pa.ListArray, rows: np.ndarray, width: int) -> np.ndarray:
    """The lists at ``rows``, each of ``width`` values, as a matrix."""
    offsets = lists.offsets.to_numpy()
    values = lists.values.to_numpy(zero_copy_only=False)
    return values[offsets[rows][:, None] + np.arange(width)]
