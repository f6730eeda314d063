"""Token counts by byte-pair merging with a heap over a linked list.

A piece of text starts as one symbol per byte.  Adjacent pairs that have a
merge rank wait in a heap; the pair of lowest rank (leftmost on ties) is popped
and merged again and again, and the neighbours of the new symbol are pushed.
The count is the number of initial symbols less the number of merges; no token
id is ever looked up.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Remembered, byte_symbols, python_path

#: Unicode White_Space, as the tokenizer's \\s has it, for a character class.
WHITE = r"\t\n\v\f\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_OTHER_SEPARATORS = regex.compile("[\x1c-\x1f]")  # str.split takes these for white space, \s does not
_WHITE = regex.compile(f"[{WHITE}]+")
_LATIN = regex.compile("[\x21-\x7e\xa1-\u024f]+")  # no composition here, and the same letters in every Unicode version


def merges(initial: list[str], ranks: dict[tuple[str, str], int]) -> int:
    """Number of merges that ``initial`` goes through."""
    symbols: list[str | None] = [*initial, None]  # the last one ends the linked list
    n = len(initial)
    left, right = list(range(-1, n)), list(range(1, n + 2))
    rank = ranks.get
    heap = [(r, i, *p) for i, p in enumerate(zip(initial, initial[1:], strict=False)) if (r := rank(p)) is not None]
    heapify(heap)
    done = 0
    while heap:
        _, i, a, b = heappop(heap)
        j = right[i]
        if symbols[i] != a or symbols[j] != b:
            continue  # one of the two has been merged since
        new = symbols[i] = a + b
        symbols[j] = None
        k = right[i] = right[j]
        left[k] = i
        done += 1
        if (after := symbols[k]) is not None and (r := rank((new, after))) is not None:
            heappush(heap, (r, i, new, after))
        if (h := left[i]) >= 0 and (r := rank((symbols[h], new))) is not None:
            heappush(heap, (r, h, symbols[h], new))
    return done


class MergeCounter:
    """Counts tokens of a lower-casing, white-space-dropping word BPE file (tokenizers JSON).

    Latin words are lower-cased and cut into pieces here.  Words with any other
    character are cut by the file's own normalizer and pre-tokenizer, as tables
    of letters and letter case differ between Unicode versions.  The merging is
    the same for both.

    Counts of words and pieces are remembered, about 2 x ``remember`` of each,
    so memory stays bounded on any number of texts.
    """

    def __init__(self, path: str, remember: int = 400_000) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark runs the tasks side by side
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        if model["type"] != "BPE" or model["continuing_subword_prefix"] or model["byte_fallback"]:
            raise ValueError(f"{path}: not a BPE vocabulary that this counter reads")
        self.ranks = {tuple(m if isinstance(m, list) else m.split(" ")): i for i, m in enumerate(model["merges"])}
        self.suffix = model["end_of_word_suffix"] or ""
        kinds = [x["type"] for x in spec["normalizer"]["normalizers"]]
        if kinds != ["NFC", "Replace", "Lowercase"]:
            raise ValueError(f"{path}: normalizer {kinds} is not supported")
        split = next(x for x in spec["pre_tokenizer"]["pretokenizers"] if x["type"] == "Split")
        self.pieces = regex.compile(split["pattern"]["Regex"])
        own = Tokenizer.from_file(path)
        self.normal, self.cut = own.normalizer.normalize_str, own.pre_tokenizer.pre_tokenize_str
        self.special = regex.compile("|".join(regex.escape(x["content"]) for x in spec["added_tokens"]) or r"(?!)")
        self.mark = [x["content"] for x in spec["added_tokens"]]
        self.symbols = {b: chr(s) for b, s in enumerate(byte_symbols())}
        self.by_word = Remembered(self.word, remember)
        self.by_piece = Remembered(self.piece, remember)

    def piece(self, shown: str) -> int:
        """Tokens of a piece, given by the stand-ins of its bytes."""
        first = list(shown)
        first[-1] += self.suffix
        return len(first) - merges(first, self.ranks)

    def word(self, text: str) -> int:
        if text.isascii() and text.isalpha():  # one piece, and its own stand-ins
            return self.by_piece[text.lower()]
        if _LATIN.fullmatch(text):
            shown = [p.encode("utf-8").decode("latin-1").translate(self.symbols) for p in self.pieces.findall(text.lower())]
        else:
            shown = [p for p, _ in self.cut(self.normal(text))]
        return sum(map(self.by_piece.__getitem__, shown))

    def count(self, text: str | None) -> int:
        """Tokens of a whole text; a special string in it is one token, as the library has it by default."""
        if not text:
            return 0
        total, parts = 0, [text]
        if any(m in text for m in self.mark):
            total, parts = len(self.special.findall(text)), self.special.split(text)
        for part in parts:
            words = _WHITE.split(part) if _OTHER_SEPARATORS.search(part) else part.split()
            total += sum(map(self.by_word.__getitem__, words))
        return total


@lru_cache(maxsize=2)
def counter(path: str) -> MergeCounter:
    """One counter for each worker process and file."""
    return MergeCounter(path)


def count_tokens(docs: DataFrame, vocabulary: str, limit: int = 2048) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_tokens, over_limit.

    ``vocabulary`` is the path of the tokenizer file on every executor.  Null
    and empty texts have 0 bytes and 0 tokens; repeated rows each get a row; a
    null doc_id is kept; an empty table gives none; other columns are not read.
    No shuffle: each task counts the rows that it scans.
    """
    python_path(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = counter(vocabulary)
        for batch in batches:
            n = pa.array([own.count(t.as_py()) for t in batch.column(2)], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), n], names=["doc_id", "n_bytes", "n_tokens"])

    text = F.col("text").cast("string")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"), text.alias("text"))
    counts = rows.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long")
    return counts.withColumn("over_limit", F.col("n_tokens") > limit)
