"""corpus_pipeline.run, each of its stages and three queries on a small written folder, against plain Python."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from tagwerk.llm import quality, queries

from .helpers import components, documents, simhash, words
from .test_quality_mix_chat import _junk, _shares


def _rows():
    """Good and bad documents, near copies, benchmark passages, null, empty and repeated rows."""
    rng = random.Random(31)
    rows, good = [], {}
    for i in range(240):
        bad = i % 4 == 0
        rows.append((i, _junk(rng, rng.randrange(4)) if bad else words(rng, rng.randrange(40, 120)) + ".", f"src{i % 3}"))
        good[i] = int(not bad)
    items = [(1, words(rng, 30)), (2, words(rng, 40)), (None, words(rng, 25)), (3, None), (4, "")]
    rows += [(300 + k, rows[4 * k + 1][1], "src1") for k in range(10)]
    rows += [(400 + k, f"{words(rng, 40)} {items[k % 3][1][20:100]} {words(rng, 40)}.", "src2") for k in range(9)]
    rows += [rows[5], (5, words(rng, 60) + ".", "src0"), (None, rows[9][1], "src0"), (None, words(rng, 60) + ".", None),
             (500, None, "src0"), (501, "", "src0"), (501, "", "src0")]
    labels = [*good.items(), (1, 1), (None, 0), (7, None)]
    return rows, labels, items


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rows, labels, items = _rows()
    path = str(tmp_path_factory.mktemp("sf"))
    documents(spark, rows).repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def _scores(rows, labels):
    texts = defaultdict(list)
    for i, t, _ in rows:
        texts[i].append(quality.features(t))
    label = {i: min(q for j, q in labels if j == i and q is not None) for i, q in labels if i is not None and q is not None}
    ids = sorted(i for i in label if i in texts)
    fitted = quality.fit_ranking(np.array([min(texts[i], key=tuple) for i in ids]), np.array([label[i] for i in ids]))
    strength = np.sort([min(fitted.strength(np.array(texts[i]))) for i in ids])
    low = sum(label[i] == 0 for i in ids)
    limit = (strength[low - 1] + strength[low]) / 2
    return [fitted.strength(quality.features(t)[None])[0] >= limit for _, t, _ in rows]


def _plain_simhash(rows):
    prints = [simhash(t) for _, t, _ in rows]
    order = sorted(range(len(rows)), key=lambda k: (rows[k][0] is None, rows[k][0] or 0, k))
    names = components(list(range(len(rows))), lambda i, j: (prints[order[i]] ^ prints[order[j]]).bit_count() <= 2)
    return [rows[order[k]] for k in range(len(rows)) if names[k] == k]


def _plain_decontaminate(rows, items):
    passages = {t[k:k + 64] for _, t in items if t for k in range(len(t) - 63)}
    return [r for r in rows if not any((r[1] or "")[k:k + 64] in passages for k in range(len(r[1] or "") - 63))]


def _plain_mix(rows):
    size = [len((t or "").split()) for _, t, _ in rows]
    per = defaultdict(int)
    for n, (_, _, s) in zip(size, rows, strict=True):
        per[s] += n
    target, out = _shares(per), []
    for r in rows:
        rate = target[r[2]] / per[r[2]] if per[r[2]] else 0.0
        draw = int(hashlib.md5(f"mix:{'null' if r[0] is None else r[0]}".encode()).hexdigest()[:13], 16) / 2**52
        out += [r] * (math.floor(rate) + (draw < rate - math.floor(rate)))
    return out


def test_every_stage_equals_plain_python(spark, folder):
    rows, labels, items = _rows()
    good = _scores(rows, labels)
    want = {"quality": [r for r, g in zip(rows, good, strict=True) if g]}
    want["simhash"] = _plain_simhash(want["quality"])
    want["decontaminate"] = _plain_decontaminate(want["simhash"], items)
    want["mix"] = _plain_mix(want["decontaminate"])
    assert len(rows) > len(want["quality"]) > len(want["simhash"]) > len(want["decontaminate"]) > 0
    docs = queries.table(spark, folder, "documents")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder)
        got = docs.select("doc_id", "text", "source").collect()
        assert Counter(map(tuple, got)) == Counter(want[name]), name
        docs = spark.createDataFrame(docs.collect(), docs.schema)
    library = Tokenizer.from_file(queries.tokenizer_path("byte_bpe_50k.json"))
    count = Counter((r[0], len(library.encode(r[1] or "", add_special_tokens=False).ids)) for r in want["mix"])
    spans = corpus_pipeline.run(spark, folder).collect()
    extra = {r.n_tokens - len(library.encode(t or "", add_special_tokens=False).ids)
             for r in spans for i, t, _ in want["mix"] if i == r.doc_id and i is not None and i != 5}
    assert len(extra) == 1  # the end mark or none, the same for every document
    more = extra.pop()
    assert more in (0, 1) and Counter((r.doc_id, r.n_tokens - more) for r in spans) == count


def test_queries_on_the_folder(spark, folder):
    rows, labels, items = _rows()
    held = {i: zlib.crc32(str(i).encode()) % 4 == 2 for i, _, _ in rows if i is not None}
    good = _scores(rows, [(i, q) for i, q in labels if i is not None and not held.get(i)])
    got = queries.op7_quality_ranking(spark, folder).collect()
    assert Counter((r.doc_id, r.held_out, r.predicted) for r in got) == Counter(
        (i, held.get(i), int(g)) for (i, _, _), g in zip(rows, good, strict=True))
    got = queries.op9_simhash_dedup(spark, folder).collect()
    assert Counter((r.doc_id, r.fingerprint) for r in got) == Counter((i, f"{simhash(t):016x}") for i, t, _ in rows)
    found = {(r.doc_id, r.item_id) for r in queries.op6_decontamination(spark, folder).collect()}
    assert found == {(400 + k, items[k % 3][0]) for k in range(9)}
