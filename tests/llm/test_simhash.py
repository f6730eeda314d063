import random

import numpy as np
import pytest

from tagwerk.llm import simhash as S

from .helpers import components, documents, simhash, words


def test_fingerprint_as_the_contract_says():
    rng = random.Random(3)
    texts = [None, "", " \t\n", "One", "One two", "A b C", "É È a\x0bb c d", *[words(rng, n) for n in (3, 4, 30, 300)],
             "same same same same same same"]
    assert [S.fingerprint(t) for t in texts] == [simhash(t) for t in texts]


def test_long_text_counts_every_shingle():
    text = words(random.Random(1), 70_000)
    assert S.fingerprint(text) == simhash(text)


def test_every_near_word_reaches_the_home():
    rng = np.random.default_rng(0)
    fp = rng.integers(0, 2**64, 400, dtype=np.uint64)
    rows, anchors = S.reached(fp, 2)
    reach = [set() for _ in fp]
    for r, a in zip(rows, anchors, strict=True):
        assert int(a) not in reach[r]
        reach[r].add(int(a))
    for i, f in enumerate(fp.tolist()):
        flips = [0, *(1 << b for b in range(64)), *(1 << a | 1 << b for a in range(64) for b in range(a))]
        near = np.array([f ^ x for x in flips], dtype=np.uint64)
        assert set(S.homes(near).tolist()) == reach[i]
        if i == 20:
            break


def test_golay_code_is_perfect():
    code = S._code()
    assert len(set(code["error"].tolist())) == 2048
    assert max(int(e).bit_count() for e in code["error"]) == 3


@pytest.mark.parametrize("threshold", [0, 1, 2])
def test_links_equal_brute_force(spark, threshold):
    rng = np.random.default_rng(5)
    base = rng.integers(0, 2**64, 60, dtype=np.uint64)
    fps = set(base.tolist())
    for f in base.tolist():
        for _ in range(6):
            for b in rng.choice(64, rng.integers(1, 4), replace=False):
                f ^= 1 << int(b)
            fps.add(f)
    signed = np.array(sorted(fps), dtype=np.uint64).view(np.int64).tolist()
    got = S.near_links(spark.createDataFrame([(f,) for f in signed], "fp long"), threshold).collect()
    want = {(min(a, b), max(a, b)) for i, a in enumerate(signed) for b in signed[:i]
            if ((a ^ b) & (2**64 - 1)).bit_count() <= threshold}
    assert len(got) == len(want) and {(r.u, r.v) for r in got} == want


@pytest.mark.parametrize("run", [S.near_duplicates, S.keep_first])
def test_copies_of_fingerprints_are_not_broadcast(spark, monkeypatch, run):
    """Spark sizes the copies, some 60 a fingerprint, like the fingerprints."""
    links, first_of = [], S.connected_components

    def seen(found):
        links.append(found)
        return first_of(found)

    monkeypatch.setattr(S, "connected_components", seen)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10m")  # Spark's own
    try:
        rows = _cases()
        assert run(documents(spark, rows)).count() == (len(rows) if run is S.near_duplicates else len(
            set(components([d for d, _ in rows], lambda i, j: (simhash(rows[i][1]) ^ simhash(rows[j][1])).bit_count() <= 2))))
        assert "Broadcast" not in links[0]._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def _cases():
    rng = random.Random(9)
    base = words(rng, 400)
    rows = [(10, base), (7, base), (30, base.upper()), (31, base + " extra"), (40, words(rng, 400)), (41, words(rng, 5)),
            (42, None), (43, ""), (44, " \n "), (45, "one"), (46, "One"), (47, "one two"), (45, "one")]
    rows += [(100 + i, base.replace(base.split()[i], "changed", 1)) for i in range(30)]
    return rows


def test_components_equal_brute_force(spark):
    rows = _cases()
    got = sorted((r.doc_id, r.fp & (2**64 - 1), r.component_id) for r in S.near_duplicates(documents(spark, rows)).collect())
    fps = [simhash(t) for _, t in rows]
    names = components([d for d, _ in rows], lambda i, j: (fps[i] ^ fps[j]).bit_count() <= 2)
    assert got == sorted((d, f, n) for (d, _), f, n in zip(rows, fps, names, strict=True))


def test_one_of_each_group_stays(spark):
    rows = _cases()
    docs = documents(spark, [*rows, (None, "no id at all"), (None, "no id at all")])
    kept = S.keep_first(docs)
    assert kept.columns == docs.columns
    fps = [simhash(t) for _, t in rows]
    names = components([d for d, _ in rows], lambda i, j: (fps[i] ^ fps[j]).bit_count() <= 2)
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == sorted(set(names))
    assert ids.count(None) >= 1


def test_rows_are_decided_not_ids(spark):
    """A unique text under a repeated id stays, a near copy under it or without an id goes."""
    rng = random.Random(21)
    two, alone, other, last = words(rng, 300), "z " + words(rng, 300), words(rng, 300), words(rng, 300)
    rows = [(2, two), (5, alone), (5, two), (6, other), (6, last), (None, two), (None, None), (9, last), (6, last)]
    want = [(2, two), (5, alone), (6, other), (6, last), (None, None)]
    got = [(r.doc_id, r.text) for r in S.keep_first(documents(spark, rows)).collect()]
    assert sorted(map(str, got)) == sorted(map(str, want))


def test_empty_table_and_clashing_columns(spark):
    assert S.near_duplicates(documents(spark, [])).collect() == []
    clash = spark.createDataFrame([(1, "a b c d", 5, 6, 7)], "doc_id long, text string, fp long, component_id long, anchor long")
    assert [tuple(r) for r in S.keep_first(clash).collect()] == [(1, "a b c d", 5, 6, 7)]


def test_chain_of_copies_is_one_component(spark):
    from tagwerk.llm.common import connected_components

    links = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 501), (501, 500), (7, 7)], "u long, v long")
    got = {r.node: r.component for r in connected_components(links).collect()}
    assert got == {**{i: 0 for i in range(201)}, 500: 500, 501: 500}
    assert connected_components(links.where("u > 1000")).collect() == []
