"""Benchmark decontamination by q-gram lemma filtering and banded alignment.

Every place of a benchmark item starts a *segment* of ``length`` characters
(the last one ends with the item).  Segments of neighbouring starts share one
entry of the index, a *stretch*, whose q-grams are those of all of them.
If a region of a document is within ``budget`` edits of a segment, the two
share at least ``length + 1 - q * (budget + 1)`` q-grams whose diagonals
(document place less segment place) differ by at most ``budget`` (q-gram
lemma).  Shared q-grams are therefore counted in diagonal bands; bands overlap
by half, so any ``budget + 1`` neighbouring diagonals lie together in one.
Bands that reach the bound are aligned by banded edit distance, and only
regions within the budget are reported.  The first segment of a stretch and the
last of an item are aligned first; the others are where these fail and the
characters that all of them hold are found within the budget.

Letter case and kinds and runs of white space do not count.  Items of under 16
characters are too short for the lemma; they are found whole, between word ends.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import python_path

HASH = np.uint64(0x9E3779B97F4A7C15)  # an odd multiplier
SEPARATOR = 10                         # between texts; white space inside of them is 32
BREAKS = {" ", chr(SEPARATOR)}
BITS = 20                              # of the tables that screen q-grams and bands
Q = 8                                  # a q-gram of one-byte characters fills one 64-bit word
TOGETHER = 32                          # segments that start within so many characters are one stretch


def plain(text: str) -> np.ndarray:
    """Code points with letter case and kinds of white space evened out, as many as the text has."""
    low = text.lower()
    if len(low) != len(text):
        low = "".join(c.lower() if len(c.lower()) == 1 else c for c in text)
    codes = np.frombuffer(low.encode("utf-32-le", "surrogatepass"), dtype="<u4").copy()
    codes[(codes >= 9) & (codes <= 13)] = 32
    return codes


def folded(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(codes with runs of white space as one, place of each in ``codes``)."""
    space = codes == 32
    places = np.flatnonzero(~(space & np.concatenate([[False], space[:-1]])))
    return codes[places], places


def _grams(codes: np.ndarray) -> np.ndarray:
    """The q-gram at each place, as eight low bytes of code points (equal texts have equal grams)."""
    low = codes.astype(np.uint8)
    return np.ndarray((max(0, len(low) - Q + 1),), dtype="<u8", buffer=low.tobytes(), strides=(1,))


@dataclass(frozen=True)
class Limits:
    """``length`` of a segment, ``stride`` between their starts, share of edits in ``rate``."""

    length: int = 64
    stride: int = 32  # 1: every excerpt of ``length`` characters is a segment
    rate: float = 0.1

    def budget(self, n: int) -> int:
        """Edits allowed in a segment of n characters; few enough that the lemma's bound is at least 2."""
        return max(0, min(int(n * self.rate), (n - 1) // Q - 1))


EVERY = Limits(stride=1)
BLOCK_CHARS = 2_000_000  # of the benchmark that are sent to the executors at once


class Benchmark:
    """The stretches of a block of benchmark items and an index of their q-grams.

    Of each stretch the q-grams that most stretches hold are left out of the
    index, ``spare`` of them at most, and its bound is lowered by as many: the
    lemma still holds, and common phrases cost little.
    """

    def __init__(self, items: list[tuple], limits: Limits, spare: int = 3) -> None:
        """Items are (id, text) or, of a part of a long item, (id, text, its place, places in it where segments start)."""
        self.limits, self.width = limits, limits.length + TOGETHER
        self.stretches: list[tuple[int, int, np.ndarray, np.ndarray, int]] = []  # item, start, text, segments in it, last of the item
        self.places: list[np.ndarray] = []  # of each stretch: where the codes of its item are in the item's text
        self.short: dict[str, list[int]] = {}
        for item, text, *part in items:
            offset, until = part or (0, None)
            codes, places = folded(plain(text))
            n = len(codes)
            if not part and n < 2 * Q:
                if (codes != 32).any():
                    self.short.setdefault("".join(map(chr, codes)).strip(), []).append(item)
                continue
            if not (codes != 32).any():
                continue
            last = max(0, n - limits.length)
            starts = [x for x in [*range(0, last, limits.stride), last] if until is None or places[x] < until]
            while starts:
                self.places.append(places + offset)
                own = [x - starts[0] for x in starts[:TOGETHER] if x - starts[0] < TOGETHER]
                stretch = codes[starts[0]:starts[0] + own[-1] + limits.length]
                self.stretches.append((item, starts[0], stretch, np.array(own, np.int32), -1 if until is not None else last - starts[0]))
                starts = starts[len(own):]
        grams = [_grams(x[2]) for x in self.stretches]
        size = np.array([len(g) for g in grams], dtype=np.int64)
        key = np.concatenate(grams) if grams else np.zeros(0, np.uint64)
        segment = np.repeat(np.arange(len(grams)), size)
        place = np.arange(len(key)) - np.repeat(np.cumsum(size) - size, size)
        self.lengths = np.array([min(len(x[2]), limits.length) for x in self.stretches], dtype=np.int64)  # of a segment
        self.edits = np.array([limits.budget(n) for n in self.lengths], dtype=np.int64)  # allowed in a segment
        self.bounds = self.lengths + 1 - Q * (self.edits + 1)
        _, which, often = np.unique(key, return_inverse=True, return_counts=True)
        by_common = np.lexsort((place, -often[which], segment))
        rank = np.empty(len(key), np.int64)
        rank[by_common] = place  # the k-th most common gram of its stretch has rank k
        room = np.clip(self.bounds - 2, 0, spare)
        kept = rank >= room[segment]
        self.bounds = self.bounds - room
        key, segment, place = key[kept], segment[kept], place[kept]
        order = np.argsort(key, kind="stable")
        self.key, first = np.unique(key[order], return_index=True)
        self.first = np.append(first, len(key))
        self.segment, self.place = segment[order], place[order]
        self.seen = np.zeros(1 << BITS, bool)
        self.seen[(self.key * HASH) >> np.uint64(64 - BITS)] = True
        self._finder = None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_finder": None}

    def whole_items(self, codes: np.ndarray) -> list[tuple[int, int, int]]:
        """(item, start, end) of the short items that stand in the text between word ends."""
        if not self.short or not len(codes):
            return []
        if self._finder is None:
            import ahocorasick

            self._finder = ahocorasick.Automaton()
            for text in self.short:
                self._finder.add_word(text, text)
            self._finder.make_automaton()
        text = codes.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass")
        out = []
        for end, found in self._finder.iter(text):
            start, end = end + 1 - len(found), end + 1
            if (start == 0 or text[start - 1] in BREAKS) and (end == len(text) or text[end] in BREAKS):
                out += [(item, start, end) for item in self.short[found]]
        return out

    @property
    def segments(self) -> list[tuple[int, int, np.ndarray]]:
        """(item, start, text) of every segment."""
        return [(item, start + int(x), codes[x:x + self.limits.length])
                for item, start, codes, own, _ in self.stretches for x in own]

    @property
    def budgets(self) -> np.ndarray:
        """Edits allowed in every segment."""
        return np.repeat(self.edits, [len(x[3]) for x in self.stretches])

    def hits(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place in the text, stretch, place in the stretch) of all shared q-grams of the index."""
        grams = _grams(codes)
        at = np.flatnonzero(self.seen[(grams * HASH) >> np.uint64(64 - BITS)])
        k = np.minimum(np.searchsorted(self.key, grams[at]), len(self.key) - 1)
        real = self.key[k] == grams[at]
        at, k = at[real], k[real]
        n = self.first[k + 1] - self.first[k]
        entry = np.repeat(self.first[k] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        return np.repeat(at, n), self.segment[entry], self.place[entry]

    def bands(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(stretch, lowest diagonal) of the bands in which enough q-grams of the stretch are shared."""
        if not len(self.key) or len(codes) < Q:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at, segment, place = self.hits(codes)
        half = self.edits[segment] + 1
        diagonal = at - place + 2 * self.width  # never negative
        found = []
        for shift in (0, 1):
            band = (diagonal + shift * half) // (2 * half)
            both = band * len(self.stretches) + segment
            # counts by a hash are never below the true ones, so this screen loses nothing
            bucket = ((both.astype(np.uint64) * HASH) >> np.uint64(64 - BITS)).astype(np.int64)
            likely = np.bincount(bucket, minlength=1 << BITS)[bucket] >= self.bounds[segment]
            # each q-gram of the stretch counts once in a band
            shared = np.unique(both[likely] * self.width + place[likely]) // self.width
            ids, count = np.unique(shared, return_counts=True)
            s = ids % len(self.stretches)
            enough = count >= self.bounds[s]
            s, b = s[enough], ids[enough] // len(self.stretches)
            half_s = self.edits[s] + 1
            found.append((s, b * 2 * half_s - shift * half_s - 2 * self.width))
        return tuple(np.concatenate(x) for x in zip(*found, strict=True))

    def verify(self, codes: np.ndarray, ends: np.ndarray, sizes: np.ndarray, stretch: np.ndarray, low: np.ndarray,
               offset: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int, int, int, int, int]]]:
        """Which segments (by stretch and offset in it) are within their budget, and their regions as ``matches`` gives them."""
        good, out = np.zeros(len(stretch), bool), []
        for i in range(0, len(stretch), 4096):
            s, x = stretch[i:i + 4096], offset[i:i + 4096]
            d = low[i:i + 4096] + x
            # the text in which the middle of the region lies
            middle = d + self.edits[s] + self.lengths[s] // 2
            own = np.minimum(np.searchsorted(ends, middle), len(ends) - 1)
            begins = ends[own] - sizes[own]
            edits, start, end = align([self.stretches[k][2][a:a + n] for k, a, n in zip(s, x, self.lengths[s], strict=True)],
                                      codes, d, self.edits[s], begins, ends[own])
            good[i:i + 4096] = edits <= self.edits[s]
            for k in np.flatnonzero(edits <= self.edits[s]):
                item, first = self.stretches[s[k]][:2]
                out.append((int(own[k]), item, int(self.places[s[k]][first + int(x[k])]), int(start[k]), int(end[k]), int(edits[k])))
        return good, out

    def _possible(self, codes: np.ndarray, stretch: np.ndarray, low: np.ndarray) -> np.ndarray:
        """False where the characters that all segments of a stretch hold are not within the budget, so no segment is."""
        out = np.zeros(len(stretch), bool)
        for i in range(0, len(stretch), 4096):
            s = stretch[i:i + 4096]
            begin = np.array([self.stretches[k][3][-1] for k in s], np.int64)
            shared = [self.stretches[k][2][a:n] for k, a, n in zip(s, begin, self.lengths[s], strict=True)]
            zero = np.zeros(len(s), np.int64)
            edits, _, _ = align(shared, codes, low[i:i + 4096] + begin, self.edits[s], zero, zero + len(codes))
            out[i:i + 4096] = edits <= self.edits[s]
        return out

    def matches(self, texts: list[str]) -> list[tuple[int, int, int, int, int, int]]:
        """(text, item, start in the item, start, end, edits) of the verified regions of ``texts``.

        The first segments of stretches and the last of items each give their
        row; another segment gives one only where no row of its item overlaps.
        """
        whole = plain("\n".join(texts))
        sizes = np.array([len(t) for t in texts], np.int64)
        ends_of = np.cumsum(sizes + 1) - 1  # a text ends before its separator
        whole[ends_of[:-1]] = SEPARATOR
        codes, places = folded(whole)
        ends = np.append(np.searchsorted(places, ends_of[:-1]), len(codes)) if len(texts) else ends_of
        begins = np.concatenate([[0], ends[:-1] + 1]) if len(texts) else ends
        rows = self._rows(codes, ends, ends - begins)
        for item, start, end in self.whole_items(codes):
            rows[int(np.searchsorted(ends, start, side="right")), item, 0, start, end] = 0
        at = np.append(places, len(whole))
        first = np.concatenate([[0], ends_of[:-1] + 1]) if len(texts) else ends_of
        found = {}
        for (text, item, begin, start, end), edits in rows.items():
            place = int(at[start] - first[text])
            found[text, item, begin, place, int(at[end - 1] + 1 - first[text]) if end > start else place] = edits
        return [(*place, edits) for place, edits in sorted(found.items(), key=_named_last)]

    def _rows(self, codes: np.ndarray, ends: np.ndarray, sizes: np.ndarray) -> dict[tuple, int]:
        """Edits by (text, item, start in the item, start, end) in folded codes."""
        stretch, low = self.bands(codes)
        ahead = [(k, x) for k, s in enumerate(stretch) for x in sorted({0, *{self.stretches[s][4]} & set(self.stretches[s][3].tolist())})]
        k, x = np.array(ahead, np.int64).reshape(-1, 2).T
        good, rows = self.verify(codes, ends, sizes, stretch[k], low[k], x)
        out = {}
        for *place, edits in rows:
            out[tuple(place)] = min(edits, out.get(tuple(place), 1 << 30))
        left = np.array([len(self.stretches[s][3]) for s in stretch], np.int64) > np.bincount(k, minlength=len(stretch))
        left[k[good]] = False
        left = np.flatnonzero(left)
        left = left[self._possible(codes, stretch[left], low[left])]
        taken: dict[tuple[int, int], list[tuple[int, int]]] = {}
        for text, item, _, start, end in out:
            taken.setdefault((text, item), []).append((start, end))
        inner = [(k, x) for k in left for x in self.stretches[stretch[k]][3]]
        k, x = np.array(inner, np.int64).reshape(-1, 2).T
        _, rows = self.verify(codes, ends, sizes, stretch[k], low[k], x)
        for *place, edits in sorted(rows, key=lambda r: (r[5], _named_last((r,)))):
            text, item, _, start, end = place
            ranges = taken.setdefault((text, item), [])
            if all(end <= a or b <= start for a, b in ranges):
                ranges.append((start, end))
                out[tuple(place)] = edits
        return out


def _named_last(row: tuple) -> tuple:
    """A sort key of a row that starts with (text, item, ...); no item comes first."""
    text, item, *rest = row[0]
    return text, item is not None, item or 0, *rest


def align(segments: list[np.ndarray], codes: np.ndarray, low: np.ndarray, budget: np.ndarray,
          begins: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each segment the fewest edits to a region of ``codes[begins:ends]`` that starts on one of
    the diagonals [low, low + 2 (budget + 1)), and the start and end of that region.

    One banded edit-distance table per segment, all filled row by row together;
    only diagonals within the budget of the band are computed.
    """
    m = np.array([len(x) for x in segments])
    rows, most = int(m.max()), int(budget.max())
    span = 2 * (most + 1) + 2 * most
    count, far = len(segments), 1 << 20
    letters = np.full((count, rows), 0xFFFFFFFE, np.int64)
    for k, x in enumerate(segments):
        letters[k, : len(x)] = x
    first = low - most
    at = first[:, None] + np.arange(span + rows)[None, :]
    window = np.where((at >= begins[:, None]) & (at < ends[:, None]), codes[np.clip(at, 0, len(codes) - 1)], 0xFFFFFFFF)
    diagonal = first[:, None] + np.arange(span)[None, :]
    steps = np.arange(span)
    usable = (diagonal >= begins[:, None]) & (diagonal <= ends[:, None])
    cost = np.where(usable, 0, far)
    origin = diagonal.copy()
    edits, start, end = np.full(count, far), np.zeros(count, np.int64), np.zeros(count, np.int64)
    pad = np.full((count, 1), far)
    for i in range(1, rows + 1):
        place = diagonal + i  # end of the text used up after this row
        legal = (place >= begins[:, None]) & (place <= ends[:, None])
        wrong = window[:, i - 1:i - 1 + span] != letters[:, i - 1:i]
        best = np.where(legal & (place > begins[:, None]), cost + wrong, far)  # match or replace
        skip = np.where(legal, np.concatenate([cost[:, 1:] + 1, pad], axis=1), far)  # letter missing in the text
        skipped = skip < best
        best = np.where(skipped, skip, best)
        origin = np.where(skipped, np.concatenate([origin[:, 1:], pad], axis=1), origin)
        run = np.minimum.accumulate(best - steps, axis=1) + steps  # extra letters in the text
        source = np.maximum.accumulate(np.where(best == run, steps, 0), axis=1)
        cost = np.where(legal, np.minimum(run, far), far)
        origin = np.take_along_axis(origin, source, axis=1)
        for k in np.flatnonzero(m == i) if (m == i).any() else ():
            b = int(np.argmin(cost[k]))
            edits[k], start[k], end[k] = cost[k, b], origin[k, b], diagonal[k, b] + i
    return edits, start, end


def parts(texts: list[str], chars: int = 1_000_000) -> Iterator[slice]:
    """Runs of texts of about ``chars`` characters together (a longer text alone is one)."""
    start = used = 0
    for k, t in enumerate(texts):
        if used and used + len(t) > chars:
            yield slice(start, k)
            start, used = k, 0
        used += len(t) + 1
    if start < len(texts):
        yield slice(start, len(texts))


def _blocks(benchmark: DataFrame, chars: int, overlap: int = 4_096) -> Iterator[list[tuple]]:
    """The items in blocks of at most ``chars`` characters, one block in memory at a time.

    A longer item (and longer than two overlaps) comes in parts that overlap,
    each with the starts of its own.
    """
    size = max(chars, 2 * overlap)
    block, used = [], 0
    rows = (benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
            .where("text is not null").orderBy("item_id", "text"))
    for row in rows.toLocalIterator():
        if len(row.text) > size:
            places = [*range(0, len(row.text) - size, size - overlap), len(row.text) - size]
            for a, b in zip(places, [*places[1:], None], strict=True):
                yield [(row.item_id, row.text[a:a + size], a, None if b is None else b - a)]
            continue
        if block and used + len(row.text) > chars:
            yield block
            block, used = [], 0
        block.append((row.item_id, row.text))
        used += len(row.text)
    if block:
        yield block


def contaminated_regions(docs: DataFrame, benchmark: DataFrame, limits: Limits = EVERY,
                         block_chars: int = BLOCK_CHARS) -> DataFrame:
    """One row per verified region: doc_id, item_id, item_start, start, end, edits.

    The query set is the benchmark, searched against all documents; it is sent
    to the executors in blocks of at most ``block_chars`` characters, so what is
    broadcast is bounded however large the benchmark is.  Places are in
    characters of the original texts.  Null and empty texts match nothing, an
    empty benchmark or table gives no rows, benchmark items without an id are
    searched under a null item_id, an item of under 16 characters is found
    whole between word ends, one of white space alone never, items and documents that repeat each give their
    rows, and columns besides ids and texts are not read.
    """
    spark = docs.sparkSession
    python_path(spark)
    schema = "doc_id long, item_id long, item_start int, start int, end int, edits int"
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = None
    for block in _blocks(benchmark, block_chars):
        held = spark.sparkContext.broadcast(Benchmark(block, limits))

        def run(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            index = held.value
            for batch in batches:
                ids, texts, out = batch.column(0).to_pylist(), [t or "" for t in batch.column(1).to_pylist()], []
                for part in parts(texts):
                    out += [(ids[part.start + k], *m) for k, *m in index.matches(texts[part])]
                columns = list(zip(*out, strict=True)) or [()] * 6
                kinds = [pa.int64(), pa.int64(), *[pa.int32()] * 4]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                                                 names=["doc_id", "item_id", "item_start", "start", "end", "edits"])

        part = rows.mapInArrow(run, schema)
        found = part if found is None else found.unionByName(part)
    return found if found is not None else spark.createDataFrame([], schema)


def contaminated_documents(docs: DataFrame, benchmark: DataFrame, limits: Limits = EVERY) -> DataFrame:
    """One row per document and benchmark item found in it: doc_id, item_id, n_regions, start, end, least_edits."""
    return (contaminated_regions(docs, benchmark, limits).groupBy("doc_id", "item_id")
            .agg(F.count(F.lit(1)).alias("n_regions"), F.min("start").alias("start"), F.max("end").alias("end"),
                 F.min("edits").alias("least_edits")))


def without_benchmark(docs: DataFrame, benchmark: DataFrame, limits: Limits = EVERY) -> DataFrame:
    """``docs`` without the rows in whose text a region of an item was verified.

    Each row is decided by its own text, whatever its doc_id, so rows that
    repeat are decided alike; null and empty texts stay, an empty table or
    benchmark changes nothing, other columns stay as they are.  No shuffle.
    """
    spark = docs.sparkSession
    python_path(spark)
    for block in _blocks(benchmark, BLOCK_CHARS):
        docs = docs.where(_clean(spark.sparkContext.broadcast(Benchmark(block, limits)))(F.col("text").cast("string")))
    return docs


def _clean(held):  # noqa: ANN001, ANN202
    """A function of texts that is false where an item of the broadcast block ``held`` is found."""

    @F.pandas_udf("boolean")
    def clean(texts):  # noqa: ANN001, ANN202
        import pandas as pd

        of = [t or "" for t in texts]
        found = {part.start + k for part in parts(of) for k, *_ in held.value.matches(of[part])}
        return pd.Series([k not in found for k in range(len(of))], dtype=bool)

    return clean
