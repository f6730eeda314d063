"""Substring dedup by content-defined chunking with a gear rolling hash.

The hash of a place is h = (h << 1) + G[byte] in 16 bits, so it depends on the
last 16 bytes alone.  A chunk ends where the hash is below a threshold (and the
chunk has ``least`` bytes, and no character is split) or at ``most`` bytes.
Cuts depend on nearby content, so text that is inserted or removed shifts no
chunk beyond its neighbourhood.  Chunks are deduplicated by 128-bit digest:
the first occurrence, by doc_id and place, stays and all others are repeats.
Runs of repeated chunks grow at both ends to the exact extent of the repeat.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import python_path, stored


@dataclass(frozen=True)
class Chunking:
    """``one_in``: a place is a cut with probability 1 / one_in; ``least`` and ``most`` bytes of a chunk."""

    one_in: int = 24
    least: int = 12
    most: int = 1024
    seed: int = 5

    def gear(self) -> np.ndarray:
        return np.random.default_rng(self.seed).integers(0, 1 << 16, 256, dtype=np.uint16)


def cut_places(raw: bytes, rule: Chunking, gear: np.ndarray | None = None) -> list[int]:
    """End of each chunk of ``raw``; the last is its length."""
    if not raw:
        return []
    data = np.frombuffer(raw, np.uint8)
    h = (rule.gear() if gear is None else gear)[data]
    for step in (1, 2, 4, 8):  # sums over 2, 4, 8, 16 bytes equal the rolling hash
        h[step:] = h[step:] + (h[:-step] << np.uint16(step))
    low = h < np.uint16(round(65536 / rule.one_in))
    low[:-1] &= (data[1:] & 0xC0) != 0x80  # not inside a character
    ends, last, n = [], 0, len(raw)
    for p in (np.flatnonzero(low) + 1).tolist():
        while p - last > rule.most:
            last = _whole(data, last + rule.most)
            ends.append(last)
        if p - last >= rule.least:
            ends.append(p)
            last = p
    while n - last > rule.most:
        last = _whole(data, last + rule.most)
        ends.append(last)
    if last < n:
        ends.append(n)
    return ends


def _whole(data: np.ndarray, p: int) -> int:
    """``p`` or the nearest start of a character before it."""
    while data[p] & 0xC0 == 0x80:
        p -= 1
    return p


ROW = ("doc_id", "row")  # names a row: its id and a hash of id and text
CANDIDATE = 48           # least bytes of whole repeated chunks in a row
CONTEXT = 160            # bytes by which such a run may grow at each end


def _rows(docs: DataFrame, *columns) -> DataFrame:
    doc_id, text = F.col("doc_id").cast("long"), F.col("text").cast("string")
    return docs.select(doc_id.alias("doc_id"), F.xxhash64(doc_id.isNull(), doc_id, text).alias("row"), text.cast("binary").alias("text"), *columns)


def chunks(docs: DataFrame, rule: Chunking = Chunking()) -> DataFrame:
    """(hi, lo, doc_id, row, start, size) of every chunk of every whole text, in bytes of its UTF-8 form."""
    python_path(docs.sparkSession)
    schema = pa.schema([("hi", pa.int64()), ("lo", pa.int64()), ("doc_id", pa.int64()), ("row", pa.int64()), ("start", pa.int64()), ("size", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gear = rule.gear()
        digest = xxhash.xxh3_128_digest
        for batch in batches:
            out, names, starts, sizes = [], [], [], []

            def take() -> pa.RecordBatch:
                pair = np.frombuffer(b"".join(out), ">i8").reshape(-1, 2).astype(np.int64)
                ids, rows = zip(*names, strict=True)
                found = pa.RecordBatch.from_arrays(
                    [pa.array(pair[:, 0]), pa.array(pair[:, 1]), pa.array(ids, pa.int64()), pa.array(rows, pa.int64()), pa.array(starts, pa.int64()),
                     pa.array(sizes, pa.int32())], schema=schema)
                for x in (out, names, starts, sizes):
                    x.clear()
                return found

            for doc_id, row, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                raw = text.as_py() or b""
                last, name = 0, (doc_id, row)
                for end in cut_places(raw, rule, gear):
                    out.append(digest(raw[last:end]))
                    names.append(name)
                    starts.append(last)
                    sizes.append(end - last)
                    last = end
                if len(out) > 100_000:
                    yield take()
            if out:
                yield take()

    return _rows(docs).mapInArrow(run, "hi long, lo long, doc_id long, row long, start long, size int")


RUN_FIELDS = ("doc_id long, row long, start long, end long, n_chunks long, n long, first_doc_id long, "
              "left_doc long, left_row long, left_at long, right_doc long, right_row long, right_at long")


def _runs(docs: DataFrame, rule: Chunking) -> DataFrame:
    """Runs of adjoining repeated chunks, with the first occurrences of their first and last chunk."""
    all_chunks = chunks(docs, rule)
    place = F.struct("doc_id", "row", "start")
    # stored, so that the join below has a plain exchange on both sides and a hot digest is split
    many = (all_chunks.groupBy("hi", "lo").agg(F.min(place).alias("first"), F.max(place).alias("last"), F.count(F.lit(1)).alias("n"))
            .where("n > 1").where(~F.col("first").eqNullSafe(F.col("last"))).select("hi", "lo", "first", "n"))
    repeats = (all_chunks.join(stored(many, "gear-digests"), ["hi", "lo"])
               .where(~F.col("first").eqNullSafe(F.struct("doc_id", "row", "start")))
               .select("doc_id", "row", F.struct("start", (F.col("start") + F.col("size")).alias("end"), F.col("first.doc_id").alias("first_doc"),
                                                 F.col("first.row").alias("first_row"), F.col("first.start").alias("first_start"), "n").alias("chunk")))
    # a set: rows that repeat in full are one, already before the shuffle; no list is longer than a text
    lists = repeats.groupBy(*ROW).agg(F.sort_array(F.collect_set("chunk")).alias("chunks"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(2).flatten()
            if not len(values):
                continue
            of = np.repeat(np.arange(batch.num_rows), np.diff(batch.column(2).offsets.to_numpy()))
            start, end, n = (values.field(k).to_numpy(zero_copy_only=False) for k in (0, 1, 5))
            fresh = np.ones(len(of), bool)
            fresh[1:] = (of[1:] != of[:-1]) | (start[1:] != end[:-1])
            first = np.flatnonzero(fresh)
            last = np.append(first[1:], len(of)) - 1
            good = end[last] - start[first] >= CANDIDATE
            longest = _longest(first[good], last[good], end - start)
            first, last = first[good], last[good]
            take = lambda k, at: values.field(k).take(pa.array(at))
            edges = np.stack([first, last + 1], 1).ravel()
            fewest = np.minimum.reduceat(n, edges[edges < len(n)])[::2] if len(first) else n[:0]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(of[first])), batch.column(1).take(pa.array(of[first])), pa.array(start[first]), pa.array(end[last]),
                 pa.array((last - first + 1).astype(np.int64)), pa.array(fewest), take(2, longest), take(2, first), take(3, first), take(4, first),
                 take(2, last), take(3, last), pa.array(values.field(4).to_numpy(zero_copy_only=False)[last] + (end - start)[last])],
                names=[f.split()[0] for f in RUN_FIELDS.split(", ")])

    return lists.mapInArrow(run, RUN_FIELDS)


def _longest(first: np.ndarray, last: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Place of the longest chunk of each run, the first of these."""
    return np.array([a + int(np.argmax(size[a:b + 1])) for a, b in zip(first.tolist(), last.tolist(), strict=True)], np.int64)


def common_end(a: bytes, b: bytes) -> int:
    """How many bytes at the end of both are equal, in whole characters."""
    n = min(len(a), len(b))
    x, y = np.frombuffer(a, np.uint8)[len(a) - n:][::-1], np.frombuffer(b, np.uint8)[len(b) - n:][::-1]
    differ = np.flatnonzero(x != y)
    n = int(differ[0]) if len(differ) else n
    while n and a[len(a) - n] & 0xC0 == 0x80:
        n -= 1
    return n


def common_begin(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    differ = np.flatnonzero(np.frombuffer(a, np.uint8)[:n] != np.frombuffer(b, np.uint8)[:n])
    n = int(differ[0]) if len(differ) else n
    while n and (n < len(a) and a[n] & 0xC0 == 0x80 or n < len(b) and b[n] & 0xC0 == 0x80):
        n -= 1
    return n


def whole_words(raw: bytes, start: int, end: int) -> int:
    """Words of raw[start:end] that do not go on outside of it."""
    words = raw[start:end].split()
    cut = 0
    if words and start and not raw[start - 1:start].isspace() and not raw[start:start + 1].isspace():
        cut += 1
    if len(words) > cut and end < len(raw) and not raw[end:end + 1].isspace() and not raw[end - 1:end].isspace():
        cut += 1
    return max(0, len(words) - cut)


def _grown(raw: bytes, runs: list[dict], shortest: int, least_words: int) -> list[tuple]:
    """(start, end, n_words, n_chunks, first_doc_id, n_copies) of the passages: runs grown at both ends, merged where they meet."""
    spans: list[list] = []
    for r in sorted(runs, key=lambda r: r["start"]):
        start = r["start"] - common_end(raw[max(0, r["start"] - CONTEXT):r["start"]], r["left"] or b"")
        end = r["end"] + common_begin(raw[r["end"]:r["end"] + CONTEXT], r["right"] or b"")
        if spans and start <= spans[-1][1]:
            s = spans[-1]
            if end - start > s[1] - s[0]:
                s[3] = r["first_doc_id"]
            s[1], s[2], s[4] = max(s[1], end), s[2] + r["n_chunks"], min(s[4], r["n"])
        else:
            spans.append([start, end, r["n_chunks"], r["first_doc_id"], r["n"]])
    found = [(s, e, whole_words(raw, s, e), chunks_, first, n) for s, e, chunks_, first, n in spans if e - s >= shortest]
    return [f for f in found if f[2] >= least_words]


def _with_runs(docs: DataFrame, rule: Chunking, *columns) -> DataFrame:
    """Rows of ``docs`` (doc_id, row, text, columns) with ``runs``, their runs and the text around the first occurrences."""
    runs = stored(_runs(docs, rule), "gear-runs")
    sides = [runs.select(F.col(f"{side}_doc").alias("doc_id"), F.col(f"{side}_row").alias("row"),
                         F.struct(F.col(f"{side}_at").alias("at"), F.lit(side == "right").alias("right")).alias("place")) for side in ("left", "right")]
    # however many rows repeat a place, it is asked for once
    wanted = stored(sides[0].unionByName(sides[1]).groupBy(*ROW).agg(F.collect_set("place").alias("places")), "gear-places")

    def around(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, row, text, places in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for p in places:
                    at = p["at"]
                    rows.append((doc_id, row, at, p["right"], text[at:at + CONTEXT] if p["right"] else text[max(0, at - CONTEXT):at]))
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.binary()), strict=True)],
                    names=["doc_id", "row", "at", "right", "around"])

    asked = _match(_rows(docs), wanted, "inner").select("doc_id", "row", "text", "places")
    texts = stored(asked.mapInArrow(around, "doc_id long, row long, at long, right boolean, around binary")
                   .dropDuplicates(["doc_id", "row", "at", "right"]), "gear-context")
    for side in ("left", "right"):
        own = texts.where(F.col("right") == (side == "right")).select(
            F.col("doc_id").alias("_d"), F.col("row").alias("_r"), F.col("at").alias("_a"), F.col("around").alias(side))
        runs = runs.join(own, F.col(f"{side}_doc").eqNullSafe(F.col("_d")) & (F.col(f"{side}_row") == F.col("_r")) & (F.col(f"{side}_at") == F.col("_a")),
                         "left").drop("_d", "_r", "_a")
    fields = F.struct("start", "end", "n_chunks", "n", "first_doc_id", "left", "right")
    lists = stored(runs.groupBy(*ROW).agg(F.collect_list(fields).alias("runs")), "gear-run-lists")
    return _match(_rows(docs, *columns), lists, "left")


def _match(rows: DataFrame, lists: DataFrame, how: str) -> DataFrame:
    named = lists.withColumnsRenamed({"doc_id": "_d", "row": "_r"})
    return rows.join(named, rows["doc_id"].eqNullSafe(named["_d"]) & (rows["row"] == named["_r"]), how).drop("_d", "_r")


def repeated_passages(docs: DataFrame, rule: Chunking = Chunking(), shortest: int = 96, least_words: int = 50) -> DataFrame:
    """One row per repeated passage: doc_id, start, end, n_bytes, n_words, n_chunks, first_doc_id, n_copies.

    A run of adjoining repeated chunks grows at both ends as far as the text
    around the first occurrences of its outer chunks is the same (up to CONTEXT
    bytes); runs that then meet are one passage.  Passages have at least
    ``shortest`` bytes and ``least_words`` whole words.  ``first_doc_id`` is the
    document with the first occurrence of the longest chunk of the longest run
    (the document itself where it repeats itself), ``n_copies`` the fewest
    occurrences of one of the chunks.  [start, end) are places in the UTF-8 form
    of the text.

    Digests are counted with partial sums before the shuffle, and the chunks
    meet the repeated digests in an equi-join that adaptive execution splits
    where a digest is hot.  Lists are per row of ``docs``, never per digest or
    per id, so none is longer than a text.

    Null and empty texts have no chunk.  Rows are told apart by id and text:
    rows that share an id, or have none, repeat one another like any others
    (no id comes first), and rows that repeat in full count as one and each get
    the same passages.  An empty table gives no rows; other columns are not read.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("end", pa.int64()), ("n_bytes", pa.int64()), ("n_words", pa.int64()),
                        ("n_chunks", pa.int64()), ("first_doc_id", pa.int64()), ("n_copies", pa.int64())])

    def passages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(doc_id, s, e, e - s, words, n_chunks, first, n) for doc_id, text, runs in zip(*(c.to_pylist() for c in batch.columns), strict=True)
                    for s, e, words, n_chunks, first, n in _grown(text, runs, shortest, least_words)]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], schema=schema)

    return (_with_runs(docs, rule).where("runs IS NOT NULL").select("doc_id", "text", "runs")
            .mapInArrow(passages, "doc_id long, start long, end long, n_bytes long, n_words long, n_chunks long, first_doc_id long, n_copies long"))


def without_repeats(docs: DataFrame, rule: Chunking = Chunking(), shortest: int = 96, least_words: int = 50) -> DataFrame:
    """``docs`` with the repeated passages (see ``repeated_passages``) cut out of ``text``.

    Rows and other columns stay, whatever their names; a row loses its own
    passages only, also if others share its id.  Null texts stay null.
    """
    schema = T.StructType([T.StructField(f"_c{i}", T.StringType() if f.name == "text" else f.dataType) for i, f in enumerate(docs.schema.fields)])
    place = docs.columns.index("text")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for text, runs in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                out, at = [], 0
                for s, e, *_ in _grown(text, runs, shortest, least_words) if runs else ():
                    out.append(text[at:s])
                    at = e
                texts.append(None if text is None else b"".join([*out, text[at:]]).decode("utf-8", "surrogatepass"))
            columns = list(batch.columns[2:])
            columns.insert(place, pa.array(texts, pa.string()))
            yield pa.RecordBatch.from_arrays(columns, names=[f"_c{i}" for i in range(len(columns))])

    others = [F.col(f"`{c}`").alias(f"_c{i}") for i, c in enumerate(docs.columns) if i != place]
    rows = _with_runs(docs, rule, *others).select("text", "runs", *[f"_c{i}" for i in range(len(docs.columns)) if i != place])
    return rows.mapInArrow(cut, schema).toDF(*docs.columns)
