import random

import numpy as np
import pytest

from tagwerk.llm import decontaminate as D

from .helpers import documents, edit_distance_region, words

ITEMS = "item_id long, text string"


def _edit(rng, text, n):
    p = list(text)
    for _ in range(n):
        i = rng.randrange(len(p))
        kind = rng.randrange(3)
        if kind == 0:
            p[i] = "q"
        elif kind == 1:
            del p[i]
        else:
            p.insert(i, "z")
    return "".join(p)


def _brute(text, items, limits=D.Limits()):
    """Items of which a segment is within its budget of a region of the text."""
    index, even = D.Benchmark(items, limits), "".join(map(chr, D.plain(text)))
    return {item for k, (item, _, codes) in enumerate(index.segments)
            if edit_distance_region("".join(map(chr, codes)), even) <= index.budgets[k]}


def test_align_equals_full_table():
    rng = random.Random(4)
    for _ in range(60):
        segment = "".join(rng.choice("abc ") for _ in range(rng.randrange(20, 40)))
        text = "".join(rng.choice("abc ") for _ in range(60))
        at = rng.randrange(60)
        text = text[:at] + _edit(rng, segment, rng.randrange(4)) + text[at:]
        budget = 4
        edits, start, end = D.align([D.plain(segment)], D.plain(text), np.array([at - 4]), np.array([budget]),
                                    np.array([0]), np.array([len(text)]))
        want = edit_distance_region(segment, text)
        if want <= budget:
            assert edits[0] == edit_distance_region(segment, text[start[0]:end[0]]) and edits[0] <= budget
        else:
            assert edits[0] > budget


def test_regions_equal_brute_force():
    rng = random.Random(5)
    items = [(i, words(rng, rng.randrange(8, 40), 50)) for i in range(12)]
    texts, want = [], []
    for k in range(60):
        host = words(rng, rng.randrange(0, 60), 50)
        item, passage = rng.choice(items)
        begin = rng.randrange(max(1, len(passage) - 70))
        part = _edit(rng, passage[begin:begin + rng.randrange(40, 140)], rng.randrange(9))
        cut = rng.randrange(len(host) + 1)
        texts.append(host[:cut] + (part.upper() if k % 3 else part.replace(" ", "\n")) + host[cut:] if k % 5 else host)
        want.append(_brute(texts[-1], items))
    index, got = D.Benchmark(items, D.Limits()), [set() for _ in texts]
    for k, item, _, start, end, edits in index.matches(texts):
        got[k].add(item)
        assert 0 <= start < end <= len(texts[k])
    assert got == want and any(want) and not all(want)


def test_every_middle_excerpt_is_found_once():
    """Exact excerpts of 64 to 96 characters from every place, alone, at a text's ends and between others."""
    rng = random.Random(15)
    items = [(i, words(rng, 60)) for i in range(3)]
    passage = items[1][1][:290]
    index = D.Benchmark([(0, items[0][1]), (1, passage), (2, items[2][1])], D.EVERY)
    for n in (64, 70, 80, 96):
        starts = range(0, len(passage) - n + 1, 1 if n == 64 else 5)
        texts = []
        for k, at in enumerate(starts):
            host = [words(rng, 12), words(rng, 12)]
            host[0] = "" if k % 4 == 1 else host[0] + "\t"
            host[1] = "" if k % 4 == 2 else " " + host[1]
            texts.append(host[0] + passage[at:at + n].upper() + host[1])
        got = index.matches(texts)
        assert {(k, item) for k, item, *_ in got} == {(k, 1) for k in range(len(texts))}
        for k, _, begin, start, end, edits in got:
            assert texts[k][start:end].lower().split() and abs(end - start - 64) <= 6 and edits <= 6 and begin <= len(passage) - 64
        ahead = {*range(0, len(passage), 32), len(passage) - 64}
        inner = [k for k, _, begin, *_ in got if begin not in ahead]
        assert len(set(inner)) == len(inner) > 0 or n > 90
        assert not set(inner) & {k for k, _, begin, *_ in got if begin in ahead}


@pytest.mark.parametrize("seed", range(2))
def test_edited_middle_excerpts_equal_brute_force(seed):
    rng = random.Random(seed)
    items = [(i, words(rng, 26, 50)[:110 + i]) for i in range(2)]
    texts = []
    for k in range(12):
        item, passage = items[k % 2]
        begin = rng.randrange(len(passage) - 64)
        texts.append(words(rng, 3, 50) + " " + _edit(rng, passage[begin:begin + rng.randrange(60, 76)], rng.randrange(2, 9)) + " " + words(rng, 3, 50))
    got = [set() for _ in texts]
    for k, item, *_ in D.Benchmark(items, D.EVERY).matches(texts):
        got[k].add(item)
    assert got == [_brute(t, items, D.EVERY) for t in texts] and any(got) and not all(got)


def test_common_grams_left_out_lose_nothing():
    rng = random.Random(8)
    items = [(i, "the common phrase of all items " + words(rng, 15)) for i in range(20)]
    texts = [words(rng, 30) + " " + _edit(rng, t, 4) for _, t in items]
    for spare in (0, 3, 6):
        found = {(k, item) for k, item, *_ in D.Benchmark(items, D.Limits(), spare).matches(texts)}
        assert {(i, i) for i in range(20)} <= found


def test_operator_rows(spark):
    rng = random.Random(6)
    items = [(i, words(rng, 20)) for i in range(6)] + [(6, "short"), (7, None), (8, ""), (9, "ÀÉ " * 30 + "日本語" * 10), (None, words(rng, 20))]
    clean = [(i, words(rng, 200)) for i in range(20)] + [(20, None), (21, ""), (22, "short"), (23, items[0][1][:30])]
    dirty = [(30 + i, words(rng, 50 * i) + " " + items[i][1] + " " + words(rng, 9000 * (i == 2))) for i in range(4)]
    dirty += [(40, items[9][1].lower()), (41, items[1][1].upper().replace(" ", "  ", 2)), (30, dirty[0][1])]
    docs, bench = documents(spark, clean + dirty), spark.createDataFrame(items, ITEMS)
    got = {(r.doc_id, r.item_id) for r in D.contaminated_documents(docs, bench).collect()}
    assert got == {(22, 6), (30, 0), (31, 1), (32, 2), (33, 3), (40, 9), (41, 1)}
    small_blocks = D.contaminated_regions(docs, bench, block_chars=100)
    assert {(r.doc_id, r.item_id) for r in small_blocks.collect()} == got
    kept = D.without_benchmark(docs, bench)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [*range(22), 23]
    whole = {r.doc_id: r for r in D.contaminated_documents(docs, bench).collect()}[31]
    assert dirty[1][1][whole.start:whole.end] == items[1][1] and whole.least_edits == 0


def test_rows_and_items_without_an_id(spark):
    rng = random.Random(16)
    passage, named = words(rng, 30), words(rng, 30)
    bench = spark.createDataFrame([(None, passage), (1, named), (None, passage)], ITEMS)
    rows = [(None, "a " + named), (None, "clean"), (3, passage + " b"), (4, named + passage), (4, "clean under the same id"), (5, None)]
    docs = documents(spark, rows)
    got = {(r.doc_id, r.item_id) for r in D.contaminated_documents(docs, bench).collect()}
    assert got == {(None, 1), (3, None), (4, 1), (4, None)}
    kept = [(r.doc_id, r.text) for r in D.without_benchmark(docs, bench).collect()]
    assert sorted(map(str, kept)) == sorted(map(str, [rows[1], rows[4], rows[5]]))


def test_empty_tables_and_clashing_columns(spark):
    docs, bench = documents(spark, [(1, "some text")]), spark.createDataFrame([], ITEMS)
    assert D.contaminated_documents(docs, bench).collect() == []
    assert D.without_benchmark(docs, bench).count() == 1
    bench = spark.createDataFrame([(1, "x" * 100)], ITEMS)
    assert D.contaminated_documents(documents(spark, []), bench).collect() == []
    clash = spark.createDataFrame([(1, "y" * 300, 5, "a")], "doc_id long, text string, item_id long, start string")
    assert [tuple(r) for r in D.without_benchmark(clash, bench).collect()] == [(1, "y" * 300, 5, "a")]


def test_repetitive_texts():
    """Text of one repeated letter or word meets many diagonals and still ends."""
    items = [(1, "a" * 200), (2, "the " * 60), (3, "no such words in there at all, really none of them")]
    got = {(k, item) for k, item, *_ in D.Benchmark(items, D.Limits()).matches(["a" * 5000, "the " * 3000, "b" * 5000])}
    assert got == {(0, 1), (1, 2)}


def test_white_space_runs_do_not_count_and_places_are_those_of_the_text():
    rng = random.Random(17)
    passage = words(rng, 40)
    index = D.Benchmark([(1, passage.replace(" ", " \n  ")), (2, "  " + words(rng, 30))], D.EVERY)
    texts = [passage.replace(" ", "  "), "x\n\n\ty   " + passage.replace(" ", "\n    ") + " \n\n z", passage, "  ", "", words(rng, 40)]
    rows = index.matches(texts)
    assert {(k, item) for k, item, *_ in rows} == {(0, 1), (1, 1), (2, 1)}
    for k, _, _, start, end, edits in rows:
        assert edits == 0 and " ".join(texts[k][start:end].split()) in passage
    for k in range(3):
        own = [r for r in rows if r[0] == k]
        assert " ".join(texts[k][min(r[3] for r in own):max(r[4] for r in own)].split()) == passage
    begins = {r[2] for r in rows if r[0] == 2}
    assert 0 in begins and max(begins) > len(passage) - 64   # places in the item as it is written


def test_short_items_are_found_whole_between_word_ends():
    items = [(1, "Forty  two"), (2, "x"), (3, "forty two"), (4, " ?"), (5, "exactly 15 char"), (6, " \n")]
    texts = ["It is FORTY\ntwo", "forty twos", "fforty two", "forty   two.", "a x b", "xx", "?", "", "forty two x", "exactly 15 char", "exactly  15\tchar s"]
    got = {(k, item, texts[k][a:b]) for k, item, _, a, b, _ in D.Benchmark(items, D.EVERY).matches(texts)}
    assert got == {(0, 1, "FORTY\ntwo"), (0, 3, "FORTY\ntwo"), (4, 2, "x"), (6, 4, "?"), (8, 1, "forty two"), (8, 3, "forty two"), (8, 2, "x"),
                   (9, 5, "exactly 15 char"), (10, 5, "exactly  15\tchar")}


def test_an_item_longer_than_a_block_comes_in_parts(spark):
    rng = random.Random(18)
    long = words(rng, 6_000)
    bench = spark.createDataFrame([(7, long), (8, "short one")], ITEMS)
    cuts = [0, 8_000, 8_100, len(long) // 2, len(long) - 100]
    docs = documents(spark, [(k, words(rng, 20) + " " + long[a:a + 100] + " " + words(rng, 20)) for k, a in enumerate(cuts)] + [(9, words(rng, 99))])
    blocks = list(D._blocks(bench, 1_000))
    assert max(sum(len(i[1]) for i in b) for b in blocks) <= 8_192 and len(blocks) > 4
    rows = D.contaminated_regions(docs, bench, block_chars=1_000).collect()
    assert {r.doc_id for r in rows} == set(range(5)) and len({(r.doc_id, r.item_start) for r in rows}) == len(rows)
    for r in rows:
        assert abs(r.item_start - cuts[r.doc_id]) <= 100
