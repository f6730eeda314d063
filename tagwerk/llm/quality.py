"""Quality scores by Bradley-Terry pairwise ranking.

The model gives every document a strength w . x of its features.  It is learnt
from preference pairs (a document of label 1 beats one of label 0) by logistic
loss on the difference of their features.  A difference says nothing about
where good ends and bad begins, so the threshold is a quantile of the strengths
of all labelled documents: the share of label 0 among them.  The weights are
learnt on a bounded sample, the threshold is not.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, replace
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagwerk.operators.bloom import keep_likely_members

from .common import python_path, stored

PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
FEATURES = ["words", "letters_per_word", "upper", "digits", "beyond_ascii", "controls", "new_words",
            "next_repeats", "most_common", "line_repeats", "spaced_marks", *PUNCTUATION]


def features(text: str | None) -> np.ndarray:
    """Features of a whole text; rates go through log(1 + 20 r), an empty text is all zero."""
    out = np.zeros(len(FEATURES))
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()
    if not words:
        return out
    n, seen = len(words), Counter(words)
    at = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    marks = at[list(PUNCTUATION.encode())]
    visible = sum(map(len, words))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    rates = [visible / n / 20, at[65:91].sum() / visible, at[48:58].sum() / visible, at[128:].sum() / visible,
             (at[:9].sum() + at[14:32].sum() + at[127]) / visible, len(seen) / n, sum(map(eq, words, words[1:])) / n,
             seen.most_common(1)[0][1] / n, 1 - len(set(lines)) / len(lines),
             sum(k for w, k in seen.items() if len(w) == 1 and not w.isalnum()) / n, *(marks / n)]
    out[0] = np.log1p(n) / 10
    out[1:] = np.log1p(20 * np.array(rates))
    return out


@dataclass(frozen=True)
class Ranking:
    """A fitted ranking: score = sigmoid(w . z(x) - threshold + logit(cut)), so score >= cut from the threshold on."""

    mean: tuple[float, ...]
    scale: tuple[float, ...]
    weights: tuple[float, ...]
    threshold: float
    cut: float

    def strength(self, x: np.ndarray) -> np.ndarray:
        return ((x - np.array(self.mean)) / np.array(self.scale) * np.array(self.weights)).sum(axis=1)

    def score(self, x: np.ndarray) -> np.ndarray:
        up = np.clip(self.strength(x) - self.threshold + np.log(self.cut / (1 - self.cut)), -30, 30)
        return 1 / (1 + np.exp(-up))


def fit_ranking(x: np.ndarray, label: np.ndarray, cut: float = 0.7, pairs: int = 60_000,
                ridge: float = 1e-3, steps: int = 40, seed: int = 7) -> Ranking:
    """Newton steps on the mean logistic loss of ``pairs`` drawn differences, with a ridge term.

    With labels of one class only (or none) there is no preference to learn:
    all scores are then exactly ``cut``, so nothing is rejected.
    """
    d = len(FEATURES)
    good, bad = np.flatnonzero(label == 1), np.flatnonzero(label == 0)
    if not len(good) or not len(bad):
        return Ranking((0.0,) * d, (1.0,) * d, (0.0,) * d, 0.0, cut)
    mean, scale = x.mean(axis=0), x.std(axis=0)
    scale = np.where(scale > 1e-9, scale, 1.0)
    z = (x - mean) / scale
    rng = np.random.default_rng(seed)
    diff = z[rng.choice(good, pairs)] - z[rng.choice(bad, pairs)]
    w = np.zeros(d)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(diff @ w, -30, 30)))
        slope = -diff.T @ (1 - p) / pairs + ridge * w
        bend = (diff * (p * (1 - p))[:, None]).T @ diff / pairs + ridge * np.eye(d)
        step = np.linalg.solve(bend, slope)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    strength = np.sort((z * w).sum(axis=1))
    low = len(bad)  # the quantile lies between the low-th smallest strength and the next
    threshold = (strength[low - 1] + strength[low]) / 2
    return Ranking(tuple(mean), tuple(scale), tuple(w), float(threshold), cut)


def _places(strength: np.ndarray) -> np.ndarray:
    """Whole numbers in the order of the strengths, one for each double."""
    bits = (strength + 0.0).view(np.int64)  # + 0.0: both zeros are one
    return np.where(bits < 0, bits ^ np.int64(2**63 - 1), bits)


def _strength_at(place: int) -> float:
    """The strength that ``_places`` gave this number."""
    return float(np.array([place if place >= 0 else place ^ (2**63 - 1)], np.int64).view(np.float64)[0])


def _nth_smallest(places: DataFrame, n: int) -> int:
    """The ``n``-th smallest (from 1) of the column ``place``, exactly.

    Four rounds of 16 bits from the top: each counts the rows by their next
    bits among those that agree with the bits found so far.  Rows are counted
    in partial sums; the driver sees at most 65,536 counts a round.
    """
    found = 0
    for shift in (48, 32, 16, 0):
        top = F.shiftright("place", shift)
        agree = places if shift == 48 else places.where(F.shiftright("place", shift + 16) == F.lit(found))
        for value, rows in sorted(map(tuple, agree.groupBy(top.alias("top")).count().collect())):
            if n <= rows:
                found = value
                break
            n -= rows
    return found


def threshold_of(docs: DataFrame, known: DataFrame, ranking: Ranking) -> float:
    """The strength between the documents of ``known`` that are to be rejected, as many as have label 0, and the rest.

    ``known``: one row of doc_id, quality per id.  Texts become numbers where
    they are read; ids and numbers alone are joined with the labels, and the
    quantile is exact over all of them.  Of documents that share an id the one
    of least strength counts.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array([features(t.as_py()) for t in batch.column(1)]).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(_places(ranking.strength(x)))], names=["doc_id", "place"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # features cost most: nearly all texts without a label are left out where they are read
    texts = keep_likely_members(texts, "doc_id", known.select("doc_id"))
    placed = texts.mapInArrow(run, "doc_id long, place long")
    least = placed.groupBy("doc_id").agg(F.min("place").alias("place"))
    places = stored(least.join(known.select("doc_id", "quality"), "doc_id").select("place", "quality"), "quality-places")
    low = places.where("quality = 0").count()
    last = _nth_smallest(places, low)
    after = places.agg(F.count(F.when(F.col("place") <= last, 1)).alias("upto"),
                       F.min(F.when(F.col("place") > last, F.col("place"))).alias("next")).first()
    first = after["next"] if after["upto"] == low else last
    return (_strength_at(last) + _strength_at(first)) / 2


def learn(docs: DataFrame, labels: DataFrame, sample: int = 4000, cut: float = 0.7) -> Ranking:
    """Fit on at most ``sample`` labelled documents of each class, those of smallest hash of their id.

    ``labels``: doc_id, quality.  The bound keeps the fit, which runs on the
    driver, at the same few megabytes for any corpus.  It cuts the classes one
    by one, so the sample does not have their shares: the threshold is taken
    from all labelled documents afterwards.  Rows without id or label teach
    nothing; an id with contradicting labels counts as label 0; of documents
    that share an id one is used.
    """
    python_path(docs.sparkSession)
    known = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
             .where("doc_id is not null and quality in (0, 1)").groupBy("doc_id").agg(F.min("quality").alias("quality"))
             .withColumn("draw", F.xxhash64("doc_id")))
    some = None
    for value in (0, 1):
        part = known.where(F.col("quality") == value).orderBy("draw", "doc_id").limit(sample)
        some = part if some is None else some.unionByName(part)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array([features(t.as_py()) for t in batch.column(2)]).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(list(x), pa.list_(pa.float64()))], names=["doc_id", "quality", "x"])

    # at most 2 x sample rows are broadcast
    text = F.col("text").cast("string").alias("text")
    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text).join(F.broadcast(some), "doc_id")
    rows = chosen.select("doc_id", "quality", "text").mapInArrow(run, "doc_id long, quality int, x array<double>")
    got = rows.groupBy("doc_id").agg(F.min("quality").alias("quality"), F.min("x").alias("x")).orderBy("doc_id").collect()
    x = np.array([r.x for r in got]).reshape(-1, len(FEATURES))
    ranking = fit_ranking(x, np.array([r.quality for r in got]), cut)
    if len({r.quality for r in got}) < 2:
        return ranking
    return replace(ranking, threshold=threshold_of(docs, known, ranking))


def score(docs: DataFrame, ranking: Ranking, name: str = "quality_score") -> DataFrame:
    """``docs`` with a column ``name`` (0 to 1), the score of the whole text; other columns pass through.

    Null and empty texts are scored by their (zero) features, rows that repeat
    alike; an empty table stays empty; an input column called ``name`` gives
    way.  No shuffle.
    """
    python_path(docs.sparkSession)

    @F.pandas_udf("double")
    def of(texts):  # noqa: ANN001, ANN202
        import pandas as pd

        if not len(texts):
            return pd.Series([], dtype=float)
        return pd.Series(ranking.score(np.array([features(t) for t in texts])))

    return docs.withColumn(name, of(F.col("text").cast("string")))
