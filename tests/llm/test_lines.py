"""Line dedup against plain Python; the tables against dictionaries."""

from __future__ import annotations

import random
from collections import defaultdict
from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F

from tagwerk.llm import line_dedup
from tagwerk.llm.queries import op11_line_dedup

from .helpers import DOCS, documents, words

WHITE = " \t\n\x0b\x0c\r"


def plain(rows, shortest=40, least=5):
    """(doc_id, n_lines, n_dropped, kept) of each row, as the contract says it."""
    def key(line):
        return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(WHITE))

    held = defaultdict(set)
    for doc_id, text in rows:
        for line in (text or "").split("\n"):
            held[key(line)].add(doc_id)
    out = []
    for doc_id, text in rows:
        kept, n = [], (text or "").split("\n")
        for line in n:
            ids = held[key(line)]
            keeper = max((i for i in ids if i is not None), default=None)
            if not (len(key(line)) >= shortest and len(ids) >= least and doc_id != keeper):
                kept.append(line)
        out.append((doc_id, len(n), len(n) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


def corpus():
    rng = random.Random(11)
    common = [words(rng, 9) for _ in range(12)]
    umlauts = "ä" * 20 + " " + "ö" * 19       # 40 characters
    short = "é" * 39                           # over 40 bytes, 39 characters
    exact = "x" * 40
    rows = []
    for i in range(60):
        lines = [rng.choice(common) for _ in range(rng.randrange(6))] + [words(rng, 8) for _ in range(3)]
        lines += [rng.choice([umlauts, short, exact, "", "   ", exact[1:]])]
        line = rng.choice(lines)
        lines += [f"\t {line.upper()} \r", line + "\x0b"]
        rng.shuffle(lines)
        rows.append((i * 3 - 20, "\n".join(lines)))
    rows += [(None, None), (None, common[0]), (None, common[0]), (7_000, ""), (7_000, common[1] + "\n" + common[1]),
             (7_000, common[1]), (9, "\n\n"), (9, "\n\n"), (8_000, "\n".join([common[2]] * 4000))]
    rows += [(100 + i, "one line that four documents hold, no more than that") for i in range(4)]
    rows += [(200 + i, "one line that five documents hold, which is enough..") for i in range(5)]
    return rows


@pytest.mark.parametrize("most_bytes", [64 << 20, 0])
def test_equals_plain_python(spark, most_bytes, monkeypatch):
    monkeypatch.setattr(line_dedup, "KEYS_A_SHARD", 3)   # several shards
    monkeypatch.setattr(line_dedup, "PROBES_A_TASK", 10)  # hot shards are dealt to several tasks
    rows = corpus()
    found = line_dedup.without_common_lines(documents(spark, rows).repartition(5), most_bytes=most_bytes)
    got = [(r.doc_id, r.n_lines, r.n_dropped, r.text) for r in found.collect()]
    assert sorted(got, key=repr) == plain(rows)
    assert all(r.kept_sha256 == sha256(r.text.encode()).hexdigest() for r in found.collect())


@pytest.mark.parametrize("most_bytes", [64 << 20, 0])
def test_empty_table_no_common_line_and_kept_columns(spark, most_bytes):
    empty = spark.createDataFrame([], DOCS)
    assert line_dedup.without_common_lines(empty, most_bytes=most_bytes).collect() == []
    docs = documents(spark, [(1, "a"), (2, None)]).select("*", F.lit(1).alias("hi"), F.lit("t").alias("shard"), F.lit(None).cast("int").alias("number"))
    found = line_dedup.without_common_lines(docs, keep=["hi", "shard", "number", "lang"], most_bytes=most_bytes)
    assert sorted((r.doc_id, r.text, r.hi, r.shard, r.number, r.lang) for r in found.collect()) == [
        (1, "a", 1, "t", None, "en"), (2, "", 1, "t", None, "en")]
    with pytest.raises(ValueError, match="n_lines"):
        line_dedup.without_common_lines(docs, keep=["n_lines"])


def test_query_equals_plain_python(spark, scratch):
    rows = corpus()
    documents(spark, rows).write.parquet(f"{scratch}/documents.parquet")
    got = [tuple(r) for r in op11_line_dedup(spark, scratch).collect()]
    assert sorted(got, key=repr) == sorted(((i, n, d, sha256(t.encode()).hexdigest()) for i, n, d, t in plain(rows)), key=repr)


@pytest.mark.parametrize("n", [0, 1, 2, 63, 5_000])
def test_line_table_is_minimal_and_perfect(n):
    rng = np.random.default_rng(n)
    hi, lo = rng.integers(0, 1 << 63, n, dtype=np.uint64), rng.integers(0, 1 << 63, n, dtype=np.uint64)
    hi[: n // 2] = hi[:1] if n else hi  # equal halves in many keys
    counts, last = rng.integers(5, 1 << 40, n), rng.integers(-50, 50, n)
    table = line_dedup.LineTable.of(line_dedup.LineTable.build(hi, lo, counts, last).row())
    assert sorted(table.index(hi, lo).tolist()) == list(range(n))
    found, keeper = table.probe(hi, lo)
    assert (found == np.minimum(counts, 0xFFFFFFFF)).all() and (keeper == last).all()
    other = rng.integers(0, 1 << 63, 20_000, dtype=np.uint64)
    assert not table.probe(other, other)[0].any()


def test_shards_agree_between_spark_and_numpy(spark):
    lo = [0, 1, -1, -(1 << 63), (1 << 63) - 1, -77]
    common = spark.createDataFrame([(i, v, 5, i) for i, v in enumerate(lo)], "hi long, lo long, n long, last long")
    for shards in (1, 3, 7, 64):
        got = {r.shard: r.load for r in line_dedup.line_tables(common, shards).collect()}
        want = defaultdict(int)
        for v in lo:
            want[(v % (1 << 64)) % shards] += 5
        assert got == dict(want)
