"""Token ids as Arrow IPC files of fixed-size lists, and their reader.

The ids of all documents, in ascending doc_id order and each closed by an end
id, form one stream.  Every task writes its range of the stream as one *shard*:
an Arrow IPC file whose record batches hold ``input_ids`` and ``mask``, fixed
size lists of ``length`` elements.  All lists have equal length, so sequence k
of a shard is at a computable place and is read without copying; the last
sequence of a shard is padded and its mask is false there.  A second, small
file names the documents of the shard: doc_id, place of the first id in the
shard, number of ids.
"""

from __future__ import annotations

import gc
import json
import os
import re
import string
import zlib
from collections.abc import Iterator
from functools import lru_cache
from struct import pack

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tagwerk.session import qualified, scratch_path

from .common import Remembered, byte_symbols, python_path, stored

_WIDE_SPACE = regex.compile(r"\s\s")
_LATIN = re.compile("[ \n\x21-\x7e\xa1-\u024f]+")
#: Fixed value: the pattern by which byte-level pre-tokenizers cut a text.
_PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
SHARD_FIELDS = "shard int, ids_path string, docs_path string, n_docs long, n_tokens long"


class Encoder:
    """Ids of whole texts by the tokenizers library, as little-endian bytes.

    A byte-level pre-tokenizer cuts before every single space that a visible
    character follows and on both sides of a single line break, so the ids of a
    text are those of its parts in a row.  A part that is a word and marks after
    it is the word and the marks; others are cut by the pre-tokenizer's pattern.
    The library's BPE model merges each once; parts are remembered, about
    2 x ``remember`` of them.  Texts with two white-space characters in a row,
    where the cuts differ, or with a special string, and parts with letters
    beyond Latin go through the whole tokenizer instead.
    """

    def __init__(self, path: str, remember: int = 700_000) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark runs the tasks side by side
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        cut = spec["pre_tokenizer"] or {}
        self.by_parts = spec["normalizer"] is None and cut.get("type") == "ByteLevel" and cut["use_regex"] and not cut["add_prefix_space"]
        self.kind = np.dtype("<u2" if max(self.tokenizer.get_vocab(with_added_tokens=True).values(), default=0) < 1 << 16 else "<u4")
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.symbols = {b: chr(s) for b, s in enumerate(byte_symbols())}
        self.space = self.symbols[ord(" ")]
        self.parts = Remembered(self._part, remember)

    def _bytes(self, ids: list[int]) -> bytes:
        return pack(f"<{len(ids)}{self.kind.char}", *ids)

    def _ask(self, text: str) -> bytes:
        return self._bytes(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def _piece(self, text: str) -> bytes:
        if text.isascii() and text != "\n":  # visible characters are their own stand-ins
            shown = text.replace(" ", self.space)
        else:
            shown = text.encode("utf-8").decode("latin-1").translate(self.symbols)
        return self._bytes([t.id for t in self.model.tokenize(shown)])

    def _part(self, text: str) -> bytes:
        if not _LATIN.fullmatch(text):
            return self._ask(text)
        word = text.rstrip(string.punctuation)
        if word[1:].isalpha() and (word[0] == " " or word.isalpha()):
            return self._piece(text) if word == text else self.parts[word] + self.parts[text[len(word):]]
        pieces = _PIECES.findall(text)
        return self._piece(text) if len(pieces) == 1 else b"".join(map(self.parts.__getitem__, pieces))

    def encode(self, text: str) -> bytes:
        if not text:
            return b""
        if not self.by_parts or _WIDE_SPACE.search(text) or text[0].isspace() or text[-1].isspace() or any(s in text for s in self.special):
            return self._ask(text)
        return b"".join(map(self.parts.__getitem__, text.replace("\n", "\0\n\0").replace(" ", "\0 ").split("\0"))) if "\0" not in text else self._ask(text)


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder for each worker process and file."""
    own = Encoder(path)
    gc.freeze()  # its tables hold no cycles and stay as long as the worker: no need to walk them again and again
    return own


class DocumentList:
    """Writes the list of a shard's documents batch by batch."""

    def __init__(self, uri: str, per_batch: int = 10_000) -> None:
        fs, path = pafs.FileSystem.from_uri(uri)
        self.schema = pa.schema([("doc_id", pa.int64()), ("place", pa.int64()), ("n_tokens", pa.int64())])
        self.sink = fs.open_output_stream(path)
        self.file = pa.ipc.new_file(self.sink, self.schema)
        self.per_batch, self.waiting, self.n = per_batch, [], 0

    def add(self, doc_id: int | None, place: int, n_tokens: int) -> None:
        self.waiting.append((doc_id, place, n_tokens))
        self.n += 1
        if len(self.waiting) >= self.per_batch:
            self._flush()

    def _flush(self) -> None:
        columns = zip(*self.waiting, strict=True)
        self.file.write_batch(pa.record_batch([pa.array(c, pa.int64()) for c in columns], schema=self.schema))
        self.waiting.clear()

    def close(self) -> None:
        if self.waiting:
            self._flush()
        self.file.close()
        self.sink.close()


class ShardWriter:
    """Writes one shard batch by batch; holds at most one batch of ids."""

    def __init__(self, uri: str, kind: np.dtype, length: int, per_batch: int) -> None:
        fs, path = pafs.FileSystem.from_uri(uri)
        fs.create_dir(os.path.dirname(path), recursive=True)
        self.length, self.full, self.kind = length, length * per_batch, kind
        item = pa.uint16() if kind.itemsize == 2 else pa.uint32()
        self.schema = pa.schema([("input_ids", pa.list_(item, length)), ("mask", pa.list_(pa.bool_(), length))],
                                metadata={"sequences_per_batch": str(per_batch)})
        self.sink = fs.open_output_stream(path)
        self.file = pa.ipc.new_file(self.sink, self.schema)
        self.waiting, self.n = bytearray(), 0

    def _batch(self, raw: bytes) -> None:
        ids = np.frombuffer(raw, dtype=self.kind)
        padded = -(-len(ids) // self.length) * self.length
        values, mask = np.zeros(padded, self.kind), np.zeros(padded, bool)
        values[: len(ids)], mask[: len(ids)] = ids, True
        arrays = [pa.FixedSizeListArray.from_arrays(pa.array(a), self.length) for a in (values, mask)]
        self.file.write_batch(pa.record_batch(arrays, schema=self.schema))

    def add(self, raw: bytes) -> None:
        self.waiting += raw
        self.n += len(raw) // self.kind.itemsize
        size = self.full * self.kind.itemsize
        while len(self.waiting) >= size:
            self._batch(bytes(self.waiting[:size]))
            del self.waiting[:size]

    def close(self) -> None:
        if self.waiting:
            self._batch(bytes(self.waiting))
        self.file.close()
        self.sink.close()


class Shard:
    """Random access to a shard: sequences by number, ids by place."""

    def __init__(self, uri: str) -> None:
        fs, path = pafs.FileSystem.from_uri(uri)
        source = pa.memory_map(path) if isinstance(fs, pafs.LocalFileSystem) else fs.open_input_file(path)
        self.reader = pa.ipc.open_file(source)
        self.per_batch = int(self.reader.schema.metadata[b"sequences_per_batch"])
        self.length = self.reader.schema.field("input_ids").type.list_size
        self._at: tuple[int, pa.RecordBatch] | None = None

    def _batch(self, k: int) -> pa.RecordBatch:
        if self._at is None or self._at[0] != k:
            self._at = (k, self.reader.get_batch(k))
        return self._at[1]

    def sequence(self, k: int) -> tuple[np.ndarray, pa.BooleanArray]:
        """Ids and mask of sequence k, both views of the file; the mask has one bit an id."""
        batch, row = self._batch(k // self.per_batch), k % self.per_batch
        return batch.column(0).slice(row, 1).flatten().to_numpy(), batch.column(1).slice(row, 1).flatten()

    def ids(self, start: int, n: int) -> Iterator[np.ndarray]:
        """The n ids from place ``start``, in pieces that do not copy."""
        full = self.per_batch * self.length
        while n > 0:
            values = self._batch(start // full).column(0).flatten().to_numpy()
            piece = values[start % full:start % full + n]
            yield piece
            start, n = start + len(piece), n - len(piece)


def write_token_files(docs: DataFrame, vocabulary: str, folder: str, length: int = 2048,
                      end_id: int = 0, per_batch: int = 64) -> DataFrame:
    """Write all documents as shards below ``folder``; return the list of shards.

    Rows are dealt by ranges of doc_id (null first) and of a hash of the text,
    so rows that share an id, or have none, are many tasks; these follow one
    another by that hash, then by text.  Null and empty texts are an end id alone; an empty table writes no
    shard.  Each attempt of a task writes files of its own and the list names
    those of the attempt that ended well, so retries leave no mixed shard.
    """
    python_path(docs.sparkSession)
    root = qualified(docs.sparkSession, folder.rstrip("/"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        own, shard = encoder(vocabulary), task.partitionId()
        stem = f"{root}/shard-{shard:06d}-{task.taskAttemptId()}"
        writer, listed, end = None, None, np.array([end_id], own.kind).tobytes()
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if writer is None:
                    writer, listed = ShardWriter(f"{stem}.arrow", own.kind, length, per_batch), DocumentList(f"{stem}.docs.arrow")
                at = writer.n
                writer.add(own.encode(text.as_py() or "") + end)
                listed.add(doc_id, at, writer.n - at)
        if writer is None:
            return
        writer.close()
        listed.close()
        yield pa.RecordBatch.from_pydict({
            "shard": pa.array([shard], pa.int32()), "ids_path": [f"{stem}.arrow"], "docs_path": [f"{stem}.docs.arrow"],
            "n_docs": pa.array([listed.n], pa.int64()), "n_tokens": pa.array([writer.n], pa.int64())})

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    hashed = F.xxhash64("text")
    dealt = rows.repartitionByRange("doc_id", hashed).sortWithinPartitions("doc_id", hashed, "text")
    return stored(dealt.mapInArrow(run, SHARD_FIELDS), "token-shards")


def read_token_files(shards: DataFrame) -> DataFrame:
    """One row per document, read back from the files: doc_id, start, n_tokens, ids_crc32, shard.

    ``start`` counts the ids of all documents before; ``ids_crc32`` is over the
    document's ids as little-endian unsigned 32-bit integers.
    """
    python_path(shards.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                shard = Shard(row["ids_path"])
                fs, path = pafs.FileSystem.from_uri(row["docs_path"])
                with fs.open_input_file(path) as source:
                    index = pa.ipc.open_file(source)
                    for k in range(index.num_record_batches):
                        part = index.get_batch(k)
                        crcs = []
                        for at, n in zip(part.column(1).to_pylist(), part.column(2).to_pylist(), strict=True):
                            crc = 0
                            for ids in shard.ids(at, n):
                                crc = zlib.crc32(ids.astype("<u4").tobytes(), crc)
                            crcs.append(crc)
                        start = pa.array(part.column(1).to_numpy() + row["first"])
                        yield pa.RecordBatch.from_arrays(
                            [part.column(0), start, part.column(2), pa.array(crcs, pa.int64()),
                             pa.array([row["shard"]] * len(crcs), pa.int32())],
                            names=["doc_id", "start", "n_tokens", "ids_crc32", "shard"])

    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row per shard
    placed = shards.withColumn("first", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).cast("long"))
    n = max(1, shards.count())
    return placed.repartitionByRange(n, "shard").mapInArrow(
        run, "doc_id long, start long, n_tokens long, ids_crc32 long, shard int")


def token_files(spark: SparkSession, docs: DataFrame, vocabulary: str, length: int = 2048,
                end_id: int = 0, folder: str | None = None) -> DataFrame:
    """Write the documents as shards in the shared folder and read them back, one row per document.

    Null and empty texts are an end id alone, rows that repeat or share an id
    are documents of their own (their order: ``write_token_files``), an empty
    table gives no rows, other columns are not read.
    """
    folder = folder or scratch_path(spark, "token-files")
    return read_token_files(write_token_files(docs, vocabulary, folder, length, end_id))
