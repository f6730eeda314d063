"""SimHash near-duplicates by anchor-point covering.

A fingerprint has 64 bits.  Two blocks of 23 bits are decoded by the binary
Golay code, which covers all 23-bit words at radius 3, so the pairs of code
words are 2^24 anchors that cover the 46 bits at radius 6.  Each fingerprint
has one *home*, its nearest anchor; it is replicated to every anchor that is
the home of some word within the threshold, all of which lie within covering
radius plus threshold of it.  If two fingerprints differ in at most
``threshold`` bits, the second is therefore replicated to the home of the
first, where the pair is compared on all 64 bits.  No linked pair is lost and
each is found once, at the home of its smaller member.

The code is linear, so which anchors a word reaches, relative to its home,
depends only on its syndrome; the tables below have one row per syndrome.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import connected_components, python_path, stored, unused

N, K = 23, 12                 # length and dimension of the code
GENERATOR = 0b110001110101    # fixed value: x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1
BLOCKS = (0, 23)              # lowest bit of each decoded block


def fingerprint(text: str | None, shingle: int = 3, seed: int = 42) -> int:
    """64-bit SimHash of the word shingles of ``text``; 0 if it has no word.

    Words are runs of non-white-space of the UTF-8 text with A-Z lower-cased,
    shingles are joined by one space, repeats count, and a bit is set if more
    than half the shingle hashes (XXH64) have it.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        grams = [b" ".join(words)]
    else:
        grams = map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False))
    counts, n = np.zeros(64, np.int64), 0
    buffer: list[int] = []

    def add() -> None:
        nonlocal counts, n
        bits = np.unpackbits(np.array(buffer, dtype="<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
        n += len(buffer)
        buffer.clear()

    for gram in grams:
        buffer.append(xxhash.xxh64_intdigest(gram, seed))
        if len(buffer) == 65536:
            add()
    if buffer:
        add()
    return int(np.packbits(counts * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3, seed: int = 42, columns: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, fp): fingerprint of every whole text as a signed long, and ``columns`` as they are.  Null texts count as empty."""
    python_path(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = np.array([fingerprint(t.as_py(), shingle, seed) for t in batch.column(1)], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fp.view(np.int64)), *batch.columns[2:]],
                                             names=["doc_id", "fp", *columns])

    more = "".join(f", {c} {docs.schema[c].dataType.simpleString()}" for c in columns)
    return (docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), *columns)
            .mapInArrow(run, "doc_id long, fp long" + more))


@lru_cache(maxsize=1)
def _code() -> dict[str, np.ndarray]:
    """Syndromes of all 23-bit words and, by syndrome, the nearest error and the reached offsets.

    ``error[s]``: the pattern of weight <= 3 with syndrome s.  Offsets are
    differences between code words as 12-bit messages; those first reached by
    e flipped bits are ``flat[e][start[e][s]:start[e][s + 1]]``.
    """
    words = np.arange(1 << N, dtype=np.int64)
    rest = words.copy()
    for i in range(N - 1, N - K - 1, -1):
        rest ^= np.where(rest >> i & 1, GENERATOR << (i - (N - K)), 0)
    error = np.zeros(1 << (N - K), np.int64)
    flips = [[sum(1 << i for i in c) for c in combinations(range(N), e)] for e in range(4)]
    for weight in flips:
        error[rest[weight]] = weight
    out = {"syndrome": rest.astype(np.int16), "error": error}
    seen = [{0} for _ in error]
    for e in range(3):
        lists = []
        for s, word in enumerate(error):  # the word of this syndrome whose home is 0
            near = {int((word ^ f) ^ error[rest[word ^ f]]) >> (N - K) for f in flips[e]}
            lists.append(sorted(near - seen[s]) if e else [0])
            seen[s] |= near
        out[f"flat{e}"] = np.array([x for row in lists for x in row], dtype=np.int64)
        out[f"start{e}"] = np.cumsum([0] + [len(row) for row in lists])
    return out


def _split(fp: np.ndarray, low: int) -> tuple[np.ndarray, np.ndarray]:
    """Syndrome and nearest code word (12-bit message) of one block."""
    code = _code()
    word = (fp >> np.uint64(low) & np.uint64((1 << N) - 1)).astype(np.int64)
    s = code["syndrome"][word].astype(np.int64)
    return s, (word ^ code["error"][s]) >> (N - K)


def homes(fp: np.ndarray) -> np.ndarray:
    """The nearest anchor of each fingerprint."""
    return _split(fp, BLOCKS[0])[1] << K | _split(fp, BLOCKS[1])[1]


def _expand(rows: np.ndarray, s: np.ndarray, e: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, offset) for each offset that syndrome s[row] first reaches by e flips."""
    start, flat = _code()[f"start{e}"], _code()[f"flat{e}"]
    n = start[s[rows] + 1] - start[s[rows]]
    at = np.repeat(start[s[rows]], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    return np.repeat(np.arange(len(rows)), n), flat[at]


def reached(fp: np.ndarray, threshold: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, anchor) for every anchor that is the home of a word within ``threshold`` bits."""
    (s1, h1), (s2, h2) = (_split(fp, low) for low in BLOCKS)
    everything, rows, anchors = np.arange(len(fp)), [], []
    for e1 in range(threshold + 1):
        at, off = _expand(everything, s1, e1)
        for e2 in range(threshold + 1 - e1):
            k, off2 = _expand(at, s2, e2)
            row = at[k]
            rows.append(row)
            anchors.append((h1[row] ^ off[k]) << K | (h2[row] ^ off2))
    return np.concatenate(rows), np.concatenate(anchors)


def near_links(prints: DataFrame, threshold: int = 2) -> DataFrame:
    """(u, v, distance): pairs of different fingerprints, u < v, at most ``threshold`` bits apart.

    ``prints`` has one distinct ``fp`` per row.  Thresholds 0 to 2.  The copies
    meet the homes in one equi-join on the anchor whose condition compares the
    bits, so only links leave it; a crowded anchor is an ordinary skewed join
    key that adaptive execution splits.  Spark sizes the copies like the few
    fingerprints they are made from and would broadcast them: they are sorted
    and merged at any size.
    """
    if not 0 <= threshold <= 2:
        raise ValueError("threshold must be 0, 1 or 2")
    python_path(prints.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for i in range(0, len(fp), 2000):
                part = fp[i:i + 2000]
                row, anchor = reached(part, threshold)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchor.astype(np.int32)), pa.array(part[row].view(np.int64))], names=["anchor", "v"])

    def home(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(homes(fp).astype(np.int32)), pa.array(fp.view(np.int64))], names=["anchor", "u"])

    one = prints.select("fp")
    copies = one.mapInArrow(run, "anchor int, v long")
    own = one.mapInArrow(home, "anchor int, u long")
    differ = F.bit_count(F.col("u").bitwiseXOR(F.col("v")))
    return (own.join(copies.hint("merge"), (own["anchor"] == copies["anchor"]) & (F.col("u") < F.col("v")) & (differ <= threshold))
            .select("u", "v", differ.cast("int").alias("distance")))


def near_duplicates(docs: DataFrame, shingle: int = 3, threshold: int = 2, seed: int = 42) -> DataFrame:
    """One row per document: ``doc_id``, ``fp`` (long), ``component_id``.

    Documents with equal fingerprints form one class before any comparison, so
    a group of copies costs one fingerprint however large it is.  The classes
    are linked by ``near_links`` and joined into components;
    ``component_id`` is the smallest doc_id of the component.

    Null and empty texts, and texts of white space only, have fingerprint 0 and
    are linked like any other.  Rows that share a doc_id each get a row; a null
    doc_id stays null and never names a component unless all ids of it are
    null.  An empty table gives no rows.  Other columns are not read.
    """
    prints = stored(fingerprints(docs, shingle, seed), "simhash-fp")
    classes = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "simhash-classes")
    return prints.join(_named(classes, threshold), "fp").select("doc_id", "fp", "component_id")


def _named(classes: DataFrame, threshold: int) -> DataFrame:
    """(fp, component_id): the smallest ``first_id`` in the component of each class (fp, first_id)."""
    links = near_links(classes, threshold)
    joined = connected_components(links.select("u", "v"))
    # components of fingerprints, named by their smallest doc_id
    named = joined.join(classes, joined["node"] == classes["fp"]).select("node", "component", "first_id")
    names = named.groupBy("component").agg(F.min("first_id").alias("name"))
    linked = named.join(names, "component").select(F.col("node").alias("fp"), "name")
    # stored, so that the last join has a plain exchange on both sides and a hot fingerprint is split
    return stored(classes.join(linked, "fp", "left")
                  .select("fp", F.coalesce("name", "first_id").alias("component_id")), "simhash-names")


def keep_first(docs: DataFrame, shingle: int = 3, threshold: int = 2) -> DataFrame:
    """``docs`` without the near copies: of each component one row stays, that of the smallest doc_id.

    Rows, not ids, are decided: each has a key of its doc_id and a 128-bit hash
    of all its columns, so different rows may share an id, and rows without an
    id come after all others.  Of rows that share a doc_id in one component the
    one of the smallest hash stays, of rows that repeat in full one.  Null and
    empty texts are linked by fingerprint 0; an empty table stays empty.
    Columns are those of ``docs``, of any name and type.
    """
    key = tuple(unused(docs, c) for c in ("_unnamed", "_id", "_hash1", "_hash2"))
    whole = []
    for field in docs.schema.fields:
        value = F.col(f"`{field.name}`")
        if "map<" in field.dataType.simpleString():  # maps have no hash
            value = F.to_json(F.struct(value))
        whole += [F.col(f"`{field.name}`").isNull(), value]
    docs_id = F.col("doc_id").cast("long")
    columns = [F.col(f"`{c}`") for c in docs.columns]
    keyed = docs.select(*columns, docs_id.isNull().alias(key[0]), F.coalesce(docs_id, F.lit(0)).alias(key[1]),
                        F.xxhash64(*whole).alias(key[2]), F.xxhash64(F.lit(1), *whole).alias(key[3]))
    prints = stored(fingerprints(keyed, shingle, columns=key), "simhash-fp")
    classes = stored(prints.groupBy("fp").agg(F.min(F.struct(*key)).alias("first_id")), "simhash-classes")
    kept = stored(_named(classes, threshold).select("component_id").distinct().select("component_id.*"), "simhash-kept")
    again = prints.groupBy(*key).count().where("count > 1").select(*key)
    single = keyed.join(kept.join(again, list(key), "left_anti"), list(key), "left_semi")
    # rows that repeat in full
    repeated = keyed.join(kept.join(again, list(key), "left_semi"), list(key), "left_semi").dropDuplicates(list(key))
    return single.unionByName(repeated).select(*columns)
