import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tagwerk.llm import mixing, perspectives, quality, simhash
from tagwerk.llm.queries import op8_chat_perspectives
from tagwerk.session import scratch_path

from .helpers import documents, words


# ---- quality

def _junk(rng, kind):
    w = words(rng, rng.randrange(5, 120)).split()
    if kind == 0:
        return " ".join(x + rng.choice(["***", "$$$", "%%%"]) for x in w)
    if kind == 1:
        return "!! ".join(w).upper()
    if kind == 2:
        return " | ".join(w)
    return " ".join(x for x in w[:5] for _ in range(9))


def _labelled(n=400, seed=3):
    rng = random.Random(seed)
    rows = [(i, words(rng, rng.randrange(3, 200)) + ".") if i % 3 else (i, _junk(rng, rng.randrange(4))) for i in range(n)]
    return rows, [(i, int(i % 3 > 0)) for i, _ in rows]


def test_ranking_separates_held_out_documents(spark):
    rows, labels = _labelled()
    docs, lab = documents(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int")
    ranking = quality.learn(docs, lab.where("doc_id < 250"))
    got = {r.doc_id: r.quality_score for r in quality.score(docs, ranking).collect()}
    right = [(got[i] >= 0.7) == bool(q) for i, q in labels if i >= 250]
    assert sum(right) / len(right) >= 0.97
    assert all(0 <= s <= 1 for s in got.values())


def test_the_threshold_is_the_quantile_of_label_zero():
    rng = np.random.default_rng(1)
    x = rng.normal(0, 1, (500, len(quality.FEATURES)))
    label = (x[:, 0] + 0.1 * rng.normal(0, 1, 500) > 0.3).astype(int)
    ranking = quality.fit_ranking(x, label)
    assert (ranking.score(x) < 0.7).sum() == (label == 0).sum()
    weights = np.abs(ranking.weights)
    assert weights.argmax() == 0 and ranking.weights[0] > 0


def test_pairs_decide_the_weights():
    """A feature that differs within no pair gets no weight; swapping the labels turns the order."""
    rng = np.random.default_rng(2)
    x = np.zeros((200, len(quality.FEATURES)))
    x[:, 3] = rng.normal(0, 1, 200)
    label = (x[:, 3] > 0).astype(int)
    up, down = quality.fit_ranking(x, label), quality.fit_ranking(x, 1 - label)
    assert up.weights[3] > 1 and down.weights[3] < -1
    assert max(abs(w) for i, w in enumerate(up.weights) if i != 3) < 1e-9


def test_one_class_rejects_nothing(spark):
    rows, _ = _labelled(30)
    docs = documents(spark, rows)
    for labels in ([], [(1, 1)], [(3, 0)], [(None, 1), (4, None), (5, 7)]):
        lab = spark.createDataFrame(labels, "doc_id long, quality int")
        scores = {r.quality_score for r in quality.score(docs, quality.learn(docs, lab)).collect()}
        assert len(scores) == 1 and scores.pop() >= 0.7


def test_sample_is_bounded_and_odd_rows_are_scored(spark):
    rows, labels = _labelled()
    odd = [(900, None), (901, ""), (902, " \n"), (None, "some words here"), (903, "x" * 200_000), (0, rows[0][1]), (904, "\x01\x02 \x7f")]
    docs = documents(spark, rows + odd)
    lab = spark.createDataFrame(labels + labels, "doc_id long, quality int")
    a, b = quality.learn(docs, lab, sample=20), quality.learn(docs.repartition(7), lab.repartition(3), sample=20)
    assert a == b
    clash = docs.selectExpr("*", "1 as x", "2 as draw", "'k' as quality")
    scored = quality.score(clash, a)
    assert scored.columns == [*clash.columns, "quality_score"] and scored.count() == len(rows + odd)
    assert all(math.isfinite(r.quality_score) for r in scored.collect())
    assert quality.score(documents(spark, []), a).collect() == []


def _strengths(ranking, rows):
    return np.sort(ranking.strength(np.array([quality.features(t) for _, t in rows])))


@pytest.mark.parametrize("sample", [20, 150, 4000])
def test_the_threshold_is_that_of_all_labels_for_any_sample(spark, sample):
    """A sample of less than a class does not have the shares of the labels; the threshold has them."""
    rng = random.Random(11)
    rows = [(i, words(rng, rng.randrange(3, 200)) + ".") if i % 7 else (i, _junk(rng, rng.randrange(4))) for i in range(1400)]
    labels = [(i, int(i % 7 > 0)) for i, _ in rows]
    docs, lab = documents(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int")
    ranking = quality.learn(docs.repartition(5), lab, sample=sample)
    strength, low = _strengths(ranking, rows), 200
    assert ranking.threshold == (strength[low - 1] + strength[low]) / 2
    assert sum(r.quality_score < 0.7 for r in quality.score(docs, ranking).collect()) == low


def test_the_threshold_of_equal_strengths_and_odd_labels(spark):
    """Texts that repeat, ids of one or two labels or without a document, rows without an id."""
    rng = random.Random(12)
    same = words(rng, 30) + "."
    rows = [(i, same if i % 3 else "$$$ " * (3 + i % 5)) for i in range(300)] + [(None, same), (1000, None), (1001, "")]
    labels = [(i, int(i % 3 > 0)) for i in range(0, 300, 2)] + [(4, 0), (None, 0), (7777, 0), (1000, 0), (1001, 0), (9, None), (11, 5)]
    docs, lab = documents(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int")
    ranking = quality.learn(docs, lab, sample=10)
    used = [(i, t) for i, t in rows if i in {d for d, q in labels if q in (0, 1)}]
    low = len({d for d, q in labels if q == 0} & {i for i, _ in used if i is not None})
    strength = _strengths(ranking, used)
    assert strength[low - 1] == strength[low] == ranking.threshold


def test_places_are_in_the_order_of_the_strengths(spark):
    rng = np.random.default_rng(4)
    some = np.concatenate([rng.normal(0, 10.0**k, 40) for k in range(-300, 300, 60)] + [[0.0, -0.0, 1.0, 1.0, -1.0, 5e-324, -5e-324]])
    places = quality._places(some)
    assert np.array_equal(np.sort(some), some[np.argsort(places, kind="stable")]) and places.dtype == np.int64
    assert all(quality._strength_at(int(p)) == s for p, s in zip(places, some, strict=True))
    table = spark.createDataFrame([(int(p),) for p in places], "place long")
    for n in (1, 2, 57, len(some) // 2, len(some)):
        assert quality._nth_smallest(table, n) == np.sort(places)[n - 1]


# ---- mixing

def _shares(sizes, weights=(5, 2, 1), most=3):
    """Share out, stop those above, share the excess again, until none is above."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, open_, left = dict.fromkeys(names, 0.0), set(names), float(sum(sizes.values()))
    while left > 1e-9 and open_:
        level, give = sum(weight[s] for s in open_), left
        for s in list(open_):
            target[s] += give * weight[s] / level
        left = 0.0
        for s in list(open_):
            if target[s] >= most * sizes[s]:
                left += target[s] - most * sizes[s]
                target[s] = float(most * sizes[s])
                open_.remove(s)
    return target


def _mix_rows(seed, n=300):
    rng = random.Random(seed)
    names = [None, "", "é", "z", *[f"src{i}" for i in range(rng.randrange(0, 9))]]
    return [(i, rng.choice([None, "", " \t", words(rng, rng.randrange(1, 30)), words(rng, 3).replace(" ", " ")]),
             rng.choice(names) if rng.random() > 0.4 else "src0") for i in range(n)]


@pytest.mark.parametrize("seed", range(4))
def test_targets_and_copies_equal_brute_force(spark, seed):
    rows = _mix_rows(seed)
    plan = mixing.plan_mix(documents(spark, rows)).collect()
    size = {d: len(re.findall("[^\x20\x09-\x0d]+", t or "")) for d, t, _ in rows}
    per = defaultdict(int)
    for d, _, s in rows:
        per[s] += size[d]
    want = _shares(per)
    for r in plan:
        assert r["size"] == size[r.doc_id] and r.source_size == per[r.source]
        assert r.target == pytest.approx(want[r.source], rel=1e-9, abs=1e-6)
        rate = r.target / r.source_size if r.source_size else 0.0
        draw = int(hashlib.md5(f"mix:{r.doc_id}".encode()).hexdigest()[:13], 16) / 2**52
        assert r.copies == math.floor(rate) + (draw < rate - math.floor(rate)) <= 3
    assert len(plan) == len(rows)


def test_mixed_rows_follow_the_plan(spark):
    rows = [*_mix_rows(9), (1, "again same id", "src0"), (None, "no id", "z")]
    docs = documents(spark, rows).selectExpr("*", "1 as size", "2 as rate", "3 as _copy", "'w' as weight", "4 as copies")
    out = mixing.mix(docs)
    assert out.columns == docs.columns
    plan = mixing.plan_mix(documents(spark, rows)).collect()
    want = Counter()
    for r in plan:
        want[r.doc_id, r.text] += r.copies
    assert Counter((r.doc_id, r.text) for r in out.collect()) == +want
    assert sorted(map(str, out.collect())) == sorted(map(str, mixing.mix(docs.repartition(5)).collect()))
    assert mixing.mix(documents(spark, [])).collect() == []
    assert mixing.mix(documents(spark, [(1, None, "a"), (2, "", None)])).collect() == []


def test_taken_words_come_near_the_target(spark):
    rng = random.Random(1)
    rows = [(i, words(rng, rng.randrange(1, 40)), f"s{i % 4}" if i % 3 else "s0") for i in range(6000)]
    taken, target = Counter(), {}
    for r in mixing.plan_mix(documents(spark, rows)).collect():
        taken[r.source] += r["size"] * r.copies
        target[r.source] = r.target
    assert all(abs(taken[s] - target[s]) < 0.1 * target[s] for s in target)


# ---- chat

TURNS = "conv_id long, turn long, role string, text string"


def _views(rows):
    talks = defaultdict(list)
    for i, (conv, turn, role, text) in enumerate(rows):
        talks[conv, i if conv is None else None].append((turn is not None, turn or 0, role or "unknown", text or "", turn))
    out = []
    for (conv, _), said in talks.items():
        said.sort(key=lambda x: x[:4])
        for who in {x[2] for x in said} - {"system"}:
            at = 0
            for seq, (_, _, speaker, text, turn) in enumerate(said):
                role = "assistant" if speaker == who else "system" if speaker == "system" else "user"
                name = speaker if role == "user" else None
                head = f"<|{role}{' ' + name if name else ''}|>\n"
                segment = f"{head}{text}<|end|>\n"
                first = at + len(head)
                out.append((conv, who, seq, turn, role, name, segment, at, first, first + len(text) * (role == "assistant")))
                at += len(segment)
    return out


@pytest.mark.parametrize("block", [1, 3, 512])
def test_perspectives_equal_brute_force(spark, block):
    rng = random.Random(7)
    rows = [(c, t, rng.choice(["user", "assistant", "system", "ann", "bob", None]), rng.choice([None, "", words(rng, 4), "é🙂"]))
            for c in range(12) for t in range(rng.randrange(0, 12))]
    rows += [(50, 1, "user", "tie"), (50, 1, "user", "tie"), (50, 1, "ann", "tie"), (50, None, "bob", "no turn"), (51, 0, "system", "alone"),
             (None, 0, "user", "no conversation"), (None, 1, "ann", "two"), (None, 1, "ann", "two"), (None, 2, "system", "alone"), (52, -5, "user", "first"), (52, 5, "user", "last")]
    got = perspectives.rotate(spark.createDataFrame([(*r, 1, "x") for r in rows], TURNS + ", seq int, name string"), block=block)
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(_views(rows), key=key)


def test_hot_conversation_and_many_rows_without_one(spark, scratch):
    """One conversation of equal turns and rows without any: blocks are of rows, and rows without one do not meet."""
    rows = [(1, 7, ("ann", "bob")[i % 2], "same") for i in range(1500)] + [(None, i, f"r{i % 900}", "t") for i in range(3000)]
    spark.createDataFrame(rows, TURNS).repartition(7).write.parquet(f"{scratch}/conversations.parquet")
    got = op8_chat_perspectives(spark, scratch)
    assert got.count() == 2 * 1500 + 3000
    assert sorted(map(tuple, got.where("conv_id = 1").collect()), key=str) == sorted(_views(rows[:1500]), key=str)
    alone = got.where("conv_id IS NULL")
    assert alone.where("seq = 0 AND start = 0 AND role = 'assistant' AND name IS NULL").count() == 3000


def test_masks_cover_what_the_perspective_says(spark):
    rows = [(1, 0, "system", "be kind"), (1, 1, "ann", "hello"), (1, 2, "bob", "hi"), (1, 3, "ann", "bye")]
    got = perspectives.rotate(spark.createDataFrame(rows, TURNS)).orderBy("perspective", "seq").collect()
    for who, said in (("ann", ["hello", "bye"]), ("bob", ["hi"])):
        own = [r for r in got if r.perspective == who]
        whole = "".join(r.segment for r in own)
        assert [whole[r.mask_start:r.mask_end] for r in own if r.mask_end > r.mask_start] == said
    assert perspectives.rotate(spark.createDataFrame([], TURNS)).collect() == []


# ---- clashing names

NAMES = ("size", "source_size", "target", "rate", "copies", "_source", "quality_score", "_id", "_hash1", "_unnamed", "_row", "_copy", "place")


def test_columns_of_any_name_pass_through(spark):
    rng = random.Random(9)
    rows = [(i, words(rng, 30)) for i in range(20)] + [(None, None), (5, ""), (5, "")]
    docs = documents(spark, rows).select("*", *[F.lit(f"own {c}").alias(c) for c in NAMES], F.create_map(F.lit("k"), "doc_id").alias("m"))
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns and {r["target"] for r in mixed.collect()} <= {"own target"}
    plan = mixing.plan_mix(docs)
    assert plan.count() == 23 and dict(plan.dtypes)["target"] == "double" and {r["_source"] for r in plan.collect()} == {"own _source"}
    kept = simhash.keep_first(docs)
    assert kept.columns == docs.columns and kept.count() == 21 and {r["_id"] for r in kept.collect()} == {"own _id"}
    labels = spark.createDataFrame([(i, i % 2) for i in range(20)], "doc_id long, quality int")
    ranking = quality.learn(docs, labels)
    scored = quality.score(docs, ranking, "own_score")
    assert {r["quality_score"] for r in scored.collect()} == {"own quality_score"} and scored.columns == [*docs.columns, "own_score"]
    stage = corpus_pipeline.STAGES[0][1]
    folder = scratch_path(spark, "clash")
    labels.withColumn("toxic", F.lit(0)).write.parquet(f"{folder}/labels.parquet")
    out = stage(spark, docs.drop("m"), folder)
    assert out.columns == docs.drop("m").columns and {r["quality_score"] for r in out.collect()} <= {"own quality_score"}
