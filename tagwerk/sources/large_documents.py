"""S3 for documents of any size: one JSON value read by many tasks.

``{"records": [{...}, ...], ...}`` in one file cannot be cut at line ends, since
a compact document has none.  It is cut at commas instead: Spark's text reader
with a comma as line end splits a file into ranges and never divides what lies
between two commas.  Three steps:

1. every range is summed up, for a start outside and inside of a string: how
   many brackets that were open before it it closes, and which it leaves open;
2. the summaries of a file, one row for each range, are composed in order, which
   gives the state that each range starts in;
3. every range cuts out its records; a record that goes on in the next range is
   put together from its parts.

The records' texts are parsed by ``from_json``.  Nothing is lost silently: a
truncated document, brackets that do not match, text after the document, a
document without the array or with two of them, and a broken record fail.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..operators.project import flatten
from ..session import scratch_path, ship_package

SPACE = b" \t\r\n"
OPEN, CLOSE = b"{[", b"}]"


def _quotes(data: np.ndarray) -> np.ndarray:
    """Which bytes are quotes that no backslash escapes."""
    quotes = data == ord('"')
    slashes = np.flatnonzero(data == ord("\\"))
    if len(slashes):
        first = np.concatenate([[True], np.diff(slashes) > 1])       # of each run of backslashes
        run = np.flatnonzero(first)
        length = np.diff(np.concatenate([run, [len(slashes)]]))
        after = slashes[run] + length
        escaped = after[(length % 2 == 1) & (after < len(data))]
        quotes[escaped] = False
    return quotes


class Span:
    """Brackets outside of strings in a piece of a document, from a start inside or outside of a string."""

    def __init__(self, text: bytes, inside: bool) -> None:
        self.text = text
        data = np.frombuffer(text, np.uint8)
        quotes = np.cumsum(_quotes(data)) + inside
        self.inside = bool(quotes[-1] & 1) if len(data) else inside
        outside = (quotes & 1) == 0
        rise = np.isin(data, list(OPEN)) & outside
        fall = np.isin(data, list(CLOSE)) & outside
        self.at = np.flatnonzero(rise | fall)
        self.step = np.where(rise[self.at], 1, -1)
        self.depth = np.cumsum(self.step)  # after each bracket, from the start
        self.outside = outside

    def named(self, at: int, field: bytes) -> bool:
        """Whether the bracket at a place is the value of ``field``."""
        before = self.text[max(0, at - len(field) - 4096):at].rstrip(SPACE)
        if not before.endswith(b":"):
            return False
        before = before[:-1].rstrip(SPACE)
        return before.endswith(field) and not before[:-len(field)].endswith(b"\\")


def summary(span: Span, field: bytes) -> dict:
    """Closers of brackets from before, brackets left open, and the depths at which an array of the field opens."""
    low = min(0, int(span.depth.min())) if len(span.depth) else 0
    end = int(span.depth[-1]) if len(span.depth) else 0
    closed = []
    for level in range(-1, low - 1, -1):  # where the depth first falls to each level
        first = int(np.argmax(span.depth == level))
        closed.append(chr(span.text[span.at[first]]))
    opened = []
    for level in range(low + 1, end + 1):
        last = int(np.flatnonzero((span.depth == level) & (span.step == 1))[-1])
        at = int(span.at[last])
        opened.append([chr(span.text[at]), span.text[at] == ord("[") and span.named(at, field)])
    arrays = [int(d) - 1 for at, d, s in zip(span.at.tolist(), span.depth.tolist(), span.step.tolist(), strict=True)
              if s == 1 and span.text[at] == ord("[") and span.named(at, field)] if field in span.text else []
    return {"inside": span.inside, "closed": closed, "opened": opened, "arrays": arrays}


def joined(first: dict, then: dict) -> dict:
    """The summary of two neighbours; ``then`` is for the state in which ``first`` ends."""
    opened, closed, bad = [*first["opened"]], [*first["closed"]], first.get("bad") or then.get("bad")
    base = len(opened) - len(closed)
    for kind in then["closed"]:
        if opened:  # the wrong one of both starts may see any brackets
            bad = _mismatch(opened.pop()[0], kind) or bad
        else:
            closed.append(kind)
    return {"inside": then["inside"], "closed": closed, "opened": opened + then["opened"],
            "arrays": first["arrays"] + [base + d for d in then["arrays"]], **({"bad": bad} if bad else {})}


def _mismatch(opener: str, closer: str) -> str | None:
    return None if opener + closer in ("{}", "[]") else f"{opener!r} is closed by {closer!r}"


def _states(ranges: list[dict], field: str, path: str) -> Iterator[dict]:
    """The state in which each range of a file starts: in a string, open brackets, the range where its open record began."""
    stack, inside, owner, arrays = [], False, None, 0
    for own in ranges:
        yield {"file": path, "block": own["block"], "inside": inside, "stack": json.dumps(stack), "owner": owner}
        change = json.loads(own["after_string" if inside else "after_text"])
        arrays += sum(len(stack) + d == 1 for d in change["arrays"])
        kept = len(stack) - len(change["closed"])
        if kept < 0:
            raise ValueError(f"more brackets closed than opened in {path}")
        wrong = [change.get("bad"), *[_mismatch(stack.pop()[0], kind) for kind in change["closed"]]]
        if any(wrong):
            raise ValueError(f"{next(filter(None, wrong))} in {path}")
        stack, inside = stack + change["opened"], change["inside"]
        within = len(stack) > 2 and stack[1][1]
        owner = (owner if within and kept > 2 else own["block"]) if within else None
    if stack or inside:
        raise ValueError(f"truncated document: {path}")
    if arrays != 1:
        raise ValueError(f"document without the array field {field!r}: {path}" if not arrays else f"the array field {field!r} twice in {path}")


def cut_records(span: Span, stack: list, field: bytes, where: str, fresh: bool) -> tuple[list[bytes], bytes | None, bool, bytes | None]:
    """(whole records, text of the record that is open at the start, whether it ends here, begin of one that goes on).

    ``stack`` holds the open brackets, ``fresh`` tells that the document has not begun.
    """
    text, whole, head, ended = span.text, [], None, False
    after_all = span.depth + len(stack)
    near = np.flatnonzero(np.maximum(after_all, after_all - span.step) <= 3)  # deeper brackets do not matter here
    in_array = len(stack) > 1 and bool(stack[1][1])
    before_us = in_array and len(stack) > 2
    start = 0 if before_us else None                      # of the record that is open
    free = 0 if in_array and len(stack) == 2 else None    # begin of what lies between records
    blank = 0 if not stack else None                      # begin of what lies outside the document
    for at, after, step in zip(span.at[near].tolist(), after_all[near].tolist(), span.step[near].tolist(), strict=True):
        before = after - step
        if (before, after) == (0, 1):
            if not fresh or text[blank:at].strip(SPACE) or text[at] != ord("{"):
                raise ValueError(f"a document is one object: {where}")
            fresh, blank = False, None
        elif (before, after) == (1, 0):
            blank = at + 1
        elif (before, after) == (1, 2):
            in_array = text[at] == ord("[") and span.named(at, field)
            free = at + 1 if in_array else None
        elif (before, after) == (2, 1) and in_array:
            _between(text[free:at], whole, where)
            in_array, free = False, None
        elif (before, after) == (2, 3) and in_array:
            if text[at] != ord("{"):
                raise ValueError(f"an element of the array is no object: {where}")
            _between(text[free:at], whole, where)
            start, free = at, None
        elif (before, after) == (3, 2) and in_array:
            if before_us:
                head, ended, before_us = text[:at + 1], True, False
            else:
                whole.append(text[start:at + 1])
            start, free = None, at + 1
    if blank is not None and text[blank:].strip(SPACE):
        raise ValueError(f"text outside the document: {where}")
    if free is not None:
        _between(text[free:], whole, where)
    if before_us:
        return whole, text, False, None
    return whole, head, ended, None if start is None else text[start:]


def _between(text: bytes, whole: list[bytes], where: str) -> None:
    """What lies between records: commas, and elements that are null."""
    for part in text.split(b","):
        part = part.strip(SPACE)
        if part == b"null":
            whole.append(part)
        elif part:
            raise ValueError(f"an element of the array is no object: {where}")


def _portions(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, bytes]]:
    """(file, block, text) in order; what a comma ended keeps it, so texts of a range follow one another."""
    waiting, key = None, None
    for batch in batches:
        files, blocks = batch.column(1).to_pylist(), batch.column(2).to_pylist()
        pieces = batch.column(0).to_pylist()
        at = 0
        while at < len(pieces):
            end = at + 1
            while end < len(pieces) and blocks[end] == blocks[at] and files[end] == files[at]:
                end += 1
            if waiting is not None and key == (files[at], blocks[at]):
                yield *key, waiting + b","
            elif waiting is not None:
                yield *key, waiting
            waiting, key = b",".join(pieces[at:end]), (files[at], blocks[at])
            at = end
    if waiting is not None:
        yield *key, waiting


def read_large_documents(spark: SparkSession, path, record_schema: T.StructType, array_field: str = "records",
                         sep: str = ".", with_file: bool = False) -> DataFrame:
    """Records of the documents at ``path``, one JSON object a file (UTF-8), nested fields flattened (P10).

    Gives the rows of ``read_records(..., multi_line=True)``; a null element is
    a row of NULLs.  Only brackets and strings are checked outside the records.
    Files are read twice, and the records' texts are written once to the shared
    scratch folder.  The driver holds one small row for each range of a file.
    """
    ship_package(spark)
    field = json.dumps(array_field, ensure_ascii=False).encode()
    pieces = (spark.read.option("lineSep", ",").text(path)
              .select(F.col("value").cast("binary").alias("value"), F.col("_metadata.file_path").alias("file"),
                      F.col("_metadata.file_block_start").alias("block")))

    def sum_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, both = None, None

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([key[0]]), pa.array([key[1]], pa.int64()), *[pa.array([json.dumps(s)]) for s in both]],
                names=["file", "block", "after_text", "after_string"])

        for file, block, text in _portions(batches):
            if key != (file, block):
                if key is not None:
                    yield row()
                key, both = (file, block), [summary(Span(text, inside), field) for inside in (False, True)]
            else:
                known = {inside: summary(Span(text, inside), field) for inside in {own["inside"] for own in both}}
                both = [joined(own, known[own["inside"]]) for own in both]
        if key is not None:
            yield row()

    sums = pieces.mapInArrow(sum_up, "file string, block long, after_text string, after_string string")
    ordered = sums.groupBy("file").agg(F.sort_array(F.collect_list(F.struct("block", "after_text", "after_string"))).alias("ranges"))

    def compose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                yield pa.RecordBatch.from_pylist(list(_states(row["ranges"], array_field, row["file"])), schema=pa.schema(
                    [("file", pa.string()), ("block", pa.int64()), ("inside", pa.bool_()), ("stack", pa.string()), ("owner", pa.int64())]))

    states = {(r["file"], r["block"]): (r["inside"], json.loads(r["stack"]), r["owner"]) for r in
              ordered.mapInArrow(compose, "file string, block long, inside boolean, stack string, owner long").collect()}
    sent = spark.sparkContext.broadcast(states)

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(file, owner, block, text): whole records without an owner, parts with the range where the record begins."""
        key, parts = None, []  # of the record that is open

        def rows(texts: list[bytes], of: int | None) -> pa.RecordBatch:
            n = len(texts)
            return pa.RecordBatch.from_arrays(
                [pa.array([key[0]] * n), pa.array([of] * n, pa.int64()), pa.array([key[1]] * n, pa.int64()), pa.array(texts, pa.binary())],
                names=["file", "owner", "block", "text"])

        for file, block, text in _portions(batches):
            fresh = key != (file, block) and block == 0
            if key != (file, block):
                if parts:
                    yield rows([b"".join(parts)], owner)
                key, parts = (file, block), []
                inside, stack, owner = sent.value[key]
            span = Span(text, inside)
            whole, head, ended, tail = cut_records(span, stack, field, file, fresh)
            change = summary(span, field)
            inside, stack = span.inside, stack[:len(stack) - len(change["closed"])] + change["opened"]
            if head is not None:
                parts.append(head)
                if ended:
                    record, parts = b"".join(parts), []
                    if owner == block:
                        whole.append(record)
                    else:
                        yield rows([record], owner)
            if whole:
                yield rows(whole, None)
            if tail is not None:
                parts, owner = [tail], block
        if parts:
            yield rows([b"".join(parts)], owner)

    found = scratch_path(spark, "record-texts")
    pieces.mapInArrow(parse, "file string, owner long, block long, text binary").write.parquet(found)
    texts = spark.read.schema("file string, owner long, block long, text binary").parquet(found)
    # a comma lies between two ranges
    parts = (texts.where("owner IS NOT NULL").groupBy("file", "owner").agg(F.sort_array(F.collect_list(F.struct("block", "text"))).alias("parts"))
             .select(F.array_join(F.transform("parts", lambda p: p["text"].cast("string")), ",").alias("text"), "file"))
    whole = texts.where("owner IS NULL").select(F.col("text").cast("string").alias("text"), "file")
    record = F.when(F.col("text") != "null", F.from_json("text", record_schema, {"mode": "FAILFAST"})).alias("record")
    rows = whole.unionByName(parts).select(F.col("file").alias("source_file"), record)
    return flatten(rows.select(*(["source_file"] if with_file else []), "record.*"), sep=sep)
