"""Periodic runs of words by internal pattern matching.

A run is a stretch of words with a smallest period q that is at least three
periods and 24 words long and that no neighbour extends.  For m = 8, 16, 32 ...
each aligned block of m words asks for its next occurrences in the window of
starts [m, 2m) after it (for m = 8 also in (0, 8)).  Every run of period q in
[m, 2m) holds such a block together with its occurrence q words on, so no run
is missed.  Occurrences of a pattern in a window shorter than twice its length
form one arithmetic progression: one or two of them are candidate periods
themselves; of three or more, whose step is the block's own period, the
candidates are the shifts that match the ends of the two periodic stretches.

Occurrences come from one suffix array over the words, by prefix doubling:
the block's class at length m is an interval of it, and a wavelet matrix over
the array answers the range successor, the smallest occurrence at or after a
place.  The classes of all doubling steps also give the longest common
extensions in both directions, by which a candidate grows to its whole run.

All documents of a portion of a batch are searched together in numpy; words of
different documents are different symbols.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from hashlib import sha256
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import python_path

BLOCK = 8            # least block; every run is at least three of them long
SHORTEST = 3 * BLOCK
PORTION = 250_000    # words searched at once, or one document
Run = tuple[int, int, int]  # start, length, period


class Wavelet:
    """Wavelet matrix over a sequence of integers below 2^bits."""

    def __init__(self, values: np.ndarray) -> None:
        self.bits = max(1, int(values.max()).bit_length()) if len(values) else 1
        self.zeros, self.split = [], []
        for bit in range(self.bits - 1, -1, -1):
            low = (values >> bit & 1) == 0
            ranks = np.zeros(len(values) + 1, np.int32)
            np.cumsum(low, out=ranks[1:])
            self.zeros.append(ranks)
            self.split.append(int(ranks[-1]))
            values = np.concatenate([values[low], values[~low]])

    def below(self, left: np.ndarray, right: np.ndarray, x: np.ndarray) -> np.ndarray:
        """How many values of [left, right) are less than x."""
        count = np.where(x >> self.bits > 0, right - left, 0)
        for level, ranks in enumerate(self.zeros):
            l0, r0 = ranks[left].astype(np.int64), ranks[right].astype(np.int64)
            one = (x >> (self.bits - 1 - level) & 1) == 1
            count += np.where(one & (x >> self.bits == 0), r0 - l0, 0)
            left = np.where(one, self.split[level] + left - l0, l0)
            right = np.where(one, self.split[level] + right - r0, r0)
        return count

    def smallest(self, left: np.ndarray, right: np.ndarray, k: np.ndarray) -> np.ndarray:
        """The k-th smallest value of [left, right), from 0."""
        value = np.zeros(len(left), np.int64)
        for level, ranks in enumerate(self.zeros):
            l0, r0 = ranks[left].astype(np.int64), ranks[right].astype(np.int64)
            one = k >= r0 - l0
            k = np.where(one, k - (r0 - l0), k)
            value = value << 1 | one
            left = np.where(one, self.split[level] + left - l0, l0)
            right = np.where(one, self.split[level] + right - r0, r0)
        return value

    def successor(self, left: np.ndarray, right: np.ndarray, x: np.ndarray, none: int) -> np.ndarray:
        """The smallest value >= x of [left, right), or ``none``."""
        before = self.below(left, right, x)
        there = np.flatnonzero(before < right - left)
        out = np.full(len(left), none, np.int64)
        out[there] = self.smallest(left[there], right[there], before[there])
        return out


class Suffixes:
    """Suffix array by prefix doubling up to ``longest`` words, with the classes of each step."""

    def __init__(self, words: np.ndarray, longest: int) -> None:
        n = self.n = len(words)
        self.classes = [np.unique(words, return_inverse=True)[1].astype(np.int64)]
        self.order = np.argsort(self.classes[0], kind="stable")
        length = 1
        while length < longest:
            own = self.classes[-1]
            after = np.zeros(n, np.int64)
            after[:n - length] = own[length:] + 1
            key = own * (n + 1) + after
            self.order = np.argsort(key)
            key = key[self.order]
            ranks = np.empty(n, np.int64)
            ranks[self.order] = np.concatenate([[0], np.cumsum(key[1:] != key[:-1])])
            self.classes.append(ranks)
            length *= 2
        self.classes = [c.astype(np.int32) for c in self.classes]

    def forward(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words from a and from b (b > a) are equal."""
        return self._extend(a, b, 1)

    def backward(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words before a and before b (b > a) are equal."""
        return self._extend(a, b, -1)

    def _extend(self, a: np.ndarray, b: np.ndarray, way: int) -> np.ndarray:
        got = np.zeros(len(a), np.int64)
        for step in range(len(self.classes) - 1, -1, -1):
            length, ranks = 1 << step, self.classes[step]
            todo = np.arange(len(a))
            while len(todo):  # once a step, but for the longest as often as it fits
                i, j = a[todo] + way * got[todo], b[todo] + way * got[todo]
                if way < 0:
                    i, j = i - length, j - length
                ok = (i >= 0) & (j + length <= self.n)
                todo, i, j = todo[ok], i[ok], j[ok]
                todo = todo[ranks[i] == ranks[j]]
                got[todo] += length
                if step < len(self.classes) - 1:
                    break
        return got


def _with_repeats(words: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Which documents hold a window of BLOCK words twice, by hash: all that do, hardly any other."""
    x = words.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(31)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(29)
    factor, length = 0xD6E8FEB86659FD93, 1
    while length < BLOCK:
        x = x[:-length] * np.uint64(factor) + x[length:]
        factor, length = factor * factor % (1 << 64), 2 * length
    ordered = np.sort(x)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return np.zeros(len(starts), bool)
    at = np.flatnonzero(np.isin(x, twice))
    first, last = np.searchsorted(at, starts), np.searchsorted(at, ends)
    return last > first


def find_runs(documents: list[np.ndarray]) -> list[list[Run]]:
    """Runs of each document, by start and period; documents are arrays of non-negative word numbers."""
    out: list[list[Run]] = [[] for _ in documents]
    long = [i for i, d in enumerate(documents) if len(d) >= SHORTEST]
    if not long:
        return out
    width = 1 + max(int(documents[i].max()) for i in long)
    sizes = np.array([len(documents[i]) for i in long])
    ends = np.cumsum(sizes)
    words = np.concatenate([documents[i].astype(np.int64) + k * width for k, i in enumerate(long)])
    left = np.flatnonzero(_with_repeats(words, ends - sizes, ends))
    if not len(left):
        return out
    words = np.concatenate([words[ends[k] - sizes[k]:ends[k]] for k in left])
    long, sizes = [long[k] for k in left], sizes[left]
    ends = np.cumsum(sizes)
    starts = ends - sizes

    longest = BLOCK
    while 2 * longest * 3 <= sizes.max():
        longest *= 2
    suffixes = Suffixes(words, longest)
    n, wavelet = len(words), Wavelet(suffixes.order)

    place, size, low, high = [], [], [], []
    m = BLOCK
    while m <= longest:
        ranks = suffixes.classes[m.bit_length() - 1]
        bounds = np.concatenate([[0], np.cumsum(np.bincount(ranks))])
        fits = sizes >= max(SHORTEST, 3 * m)
        counts = sizes[fits] // m
        p = np.repeat(starts[fits] - np.concatenate([[0], np.cumsum(counts)[:-1]]) * m, counts) + np.arange(counts.sum()) * m
        a, b = bounds[ranks[p]], bounds[ranks[p] + 1]
        again = b - a > 1
        place.append(p[again])
        size.append(np.full(again.sum(), m))
        low.append(a[again])
        high.append(b[again])
        m *= 2
    p, m, a, b = (np.concatenate(x) for x in (place, size, low, high))
    at, period = _candidates(suffixes, wavelet, p, m, a, b, 4 * n)
    if not len(at):
        return out
    start, end = at - suffixes.backward(at, at + period), at + period + suffixes.forward(at, at + period)
    good = (end - start >= SHORTEST) & (end - start >= 3 * period)
    rows = np.unique(np.stack([start[good], end[good], period[good]], axis=1), axis=0)
    first = np.ones(len(rows), bool)
    first[1:] = (rows[1:, :2] != rows[:-1, :2]).any(axis=1)  # of one stretch the smallest period
    for s, e, q in rows[first].tolist():
        k = int(np.searchsorted(ends, s, side="right"))
        out[long[k]].append((s - int(starts[k]), e - s, q))
    return out


def _candidates(suffixes: Suffixes, wavelet: Wavelet, p: np.ndarray, m: np.ndarray, a: np.ndarray, b: np.ndarray,
                none: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, period) that the blocks of m words at p, of the interval [a, b) of the suffix array, call for."""
    small = m == BLOCK
    near = wavelet.successor(a[small], b[small], p[small] + 1, none)
    hit = near < p[small] + BLOCK
    places, periods = [p[small][hit]], [(near - p[small])[hit]]

    stop, found, x = p + 2 * m, [], p + m
    rows = np.arange(len(p))
    for _ in range(3):  # the first three occurrences in the window
        got = np.full(len(p), none, np.int64)
        got[rows] = wavelet.successor(a[rows], b[rows], x[rows], none)
        got[got >= stop] = none
        found.append(got)
        rows = np.flatnonzero(got < none)
        x = got + 1
    one, two, three = found
    for got in (one, two):
        single = (got < none) & (three == none)
        places.append(p[single])
        periods.append((got - p)[single])
    row = np.flatnonzero(three < none)
    here, there, step = p[row], one[row], (two - one)[row]
    by_end = there + suffixes.forward(there, there + step) - here - suffixes.forward(here, here + step)
    by_start = there - suffixes.backward(there, there + step) - here + suffixes.backward(here, here + step)
    for q in (by_end, by_start):
        fits = (q >= m[row]) & (q < 2 * m[row])
        places.append(here[fits])
        periods.append(q[fits])
    return np.concatenate(places), np.concatenate(periods)


def collapsed(words: list, runs: list[Run]) -> list:
    """``words`` without those that a run holds after its first period."""
    if not runs:
        return words
    change = np.zeros(len(words) + 1, np.int32)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()]


def leading(runs: list[Run]) -> Run | None:
    """The run of the greatest length / period; of equals the first start, then the least period."""
    best = None
    for run in runs:
        if best is None or (by := run[1] * best[2] - best[1] * run[2]) > 0 or by == 0 and (run[0], run[2]) < (best[0], best[2]):
            best = run
    return best


def with_planted_run(words: list, doc_id: int | None) -> list:
    """A periodic end for a tenth of the documents, chosen by crc32 of the id."""
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    cycle = words[a:a + p]
    return words[:a] + (cycle * -(-(n - a) // p))[:n - a]


FIELDS = ("doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, "
          "collapsed_sha256 string")


def document_runs(docs: DataFrame, planted: bool = False, with_text: bool = False) -> DataFrame:
    """One row per row: doc_id, n_runs, the leading run and digests of all runs and of the collapsed text.

    Words are runs of anything but ASCII white space.  ``start``, ``length``
    and ``period`` (words) and ``exponent_milli`` = floor(1000 * length /
    period) describe the run of the greatest length / period (ties: smallest
    start, then period), null if there is none.  ``runs_sha256`` is over a line
    ``start,length,period`` for every run, ``collapsed_sha256`` over the words
    that no run repeats, joined by one space; ``with_text`` adds both as the
    columns ``runs`` (array of structs) and ``collapsed``.  ``planted`` first
    gives a tenth of the documents a periodic end (``with_planted_run``; rows
    without an id stay as they are).

    Null, empty and blank texts have no word and no run.  Every row is searched
    by itself, whole, whatever its length, so repeated rows and ids give equal
    rows each.  An empty table gives no rows; other columns are not read.
    """
    python_path(docs.sparkSession)
    more = ", runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string" if with_text else ""

    def result(portion: list[tuple[int | None, list[bytes]]], numbers: list[np.ndarray]) -> pa.RecordBatch:
        rows = []
        for (doc_id, words), runs in zip(portion, find_runs(numbers), strict=True):
            runs.sort(key=lambda r: (r[0], r[2]))
            best = leading(runs)
            head = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
            kept = b" ".join(collapsed(words, runs))
            listed = "".join(f"{s},{length},{q}\n" for s, length, q in runs).encode()
            row = (doc_id, len(runs), *head, sha256(listed).hexdigest(), sha256(kept).hexdigest())
            rows.append((*row, [dict(zip(("start", "length", "period"), r, strict=True)) for r in runs], kept.decode("utf-8", "surrogatepass"))
                        if with_text else row)
        run_type = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
        types = [*repeat(pa.int64(), 6), pa.string(), pa.string(), *([run_type, pa.string()] if with_text else [])]
        names = [f.split(":")[0].split()[0] for f in FIELDS.split(", ")] + (["runs", "collapsed"] if with_text else [])
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            portion, numbers, known, total = [], [], {}, 0
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                words = (text.as_py() or b"").split()
                if planted:
                    words = with_planted_run(words, doc_id)
                if portion and total + len(words) > PORTION:
                    yield result(portion, numbers)
                    portion, numbers, known, total = [], [], {}, 0
                portion.append((doc_id, words))
                numbers.append(np.array([known.setdefault(w, len(known)) for w in words], np.int64))
                total += len(words)
            if portion:
                yield result(portion, numbers)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text"))
    return rows.mapInArrow(run, FIELDS + more)
