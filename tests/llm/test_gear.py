import random
import re
from collections import defaultdict

from pyspark.sql import functions as F

from tagwerk.llm import gear_dedup as G
from tagwerk.llm.queries import op1_substring_dedup

from .helpers import documents, words


def _cuts(raw, rule):
    """Byte by byte with the rolling hash."""
    gear, h, last, ends = rule.gear().tolist(), 0, 0, []
    for i, b in enumerate(raw):
        h = (h << 1) + gear[b] & 0xFFFF
        p = i + 1
        whole = p == len(raw) or raw[p] & 0xC0 != 0x80
        if p - last > rule.most:
            q = last + rule.most
            while raw[q] & 0xC0 == 0x80:
                q -= 1
            ends.append(q)
            last = q
        if h < round(65536 / rule.one_in) and whole and p - last >= rule.least:
            ends.append(p)
            last = p
    while len(raw) - last > rule.most:
        q = last + rule.most
        while raw[q] & 0xC0 == 0x80:
            q -= 1
        ends.append(q)
        last = q
    return ends + [len(raw)] * (last < len(raw))


def test_cuts_equal_the_rolling_hash():
    rng = random.Random(1)
    for rule in (G.Chunking(), G.Chunking(one_in=4, least=1, most=20), G.Chunking(one_in=300, most=64)):
        for text in ["", "a", "é" * 400, "aaaa" * 500, words(rng, 400), "日本語テスト" * 90, "x" * 3000]:
            raw = text.encode()
            ends = G.cut_places(raw, rule)
            assert ends == _cuts(raw, rule) and (ends[-1:] == [len(raw)] or not raw)
            last = 0
            for e in ends:
                raw[last:e].decode()  # no character is split
                last = e


def test_cuts_survive_an_insertion():
    rng = random.Random(2)
    a = words(rng, 1000).encode()
    b = a[:2000] + b"an insertion" + a[2000:]
    far = lambda ends, shift: {e - shift for e in ends if e - shift > 2300}
    assert far(G.cut_places(a, G.Chunking()), 0) == far(G.cut_places(b, G.Chunking()), 12)


def _brute(rows, rule=G.Chunking(), shortest=96, least_words=50):
    """Passages of rows with distinct ids, byte by byte."""
    seen, raws = defaultdict(list), {d: (t or "").encode() for d, t in rows}
    for d, raw in raws.items():
        last = 0
        for e in G.cut_places(raw, rule):
            seen[raw[last:e]].append((d, last))
            last = e
    out = []
    for d, raw in sorted(raws.items()):
        runs, last = [], 0
        for e in G.cut_places(raw, rule):
            places, s, last = seen[raw[last:e]], last, e
            if min(places) == (d, s):
                continue
            if runs and runs[-1][-1][1] == s:
                runs[-1].append((s, e, min(places), len(places)))
            else:
                runs.append([(s, e, min(places), len(places))])
        spans = []
        for run in runs:
            (s, _, (fd, fs), _), (ls, e, (gd, gs), _) = run[0], run[-1]
            if e - s < G.CANDIDATE:
                continue
            longest = max(run, key=lambda c: (c[1] - c[0], -c[0]))
            f, g, ge, left, right = raws[fd], raws[gd], gs + e - ls, 0, 0
            while left < G.CONTEXT and s - left > 0 and fs - left > 0 and raw[s - left - 1] == f[fs - left - 1]:
                left += 1
            while left and raw[s - left] & 0xC0 == 0x80:
                left -= 1
            while right < G.CONTEXT and e + right < len(raw) and ge + right < len(g) and raw[e + right] == g[ge + right]:
                right += 1
            while right and any(x + right < len(t) and t[x + right] & 0xC0 == 0x80 for x, t in ((e, raw), (ge, g))):
                right -= 1
            new = [s - left, e + right, len(run), longest[2][0], min(c[3] for c in run)]
            if spans and new[0] <= spans[-1][1]:
                old = spans.pop()
                first = new[3] if new[1] - new[0] > old[1] - old[0] else old[3]
                new = [old[0], max(old[1], new[1]), old[2] + new[2], first, min(old[4], new[4])]
            spans.append(new)
        for s, e, k, first, n in spans:
            text = raw.decode()
            a, b = len(raw[:s].decode()), len(raw[:e].decode())
            n_words = sum(1 for m in re.finditer("[^ \n\t]+", text) if a <= m.start() and m.end() <= b)
            if e - s >= shortest and n_words >= least_words:
                out.append((d, s, e, e - s, n_words, k, first, n))
    return sorted(out)


def _rows():
    rng = random.Random(3)
    shared = [words(rng, 60) for _ in range(5)]
    rows = [(i, words(rng, rng.randrange(1, 200)) + " " + (shared[i % 5] if i % 3 == 0 else "") + " " + words(rng, 30)) for i in range(40)]
    rows += [(50, rows[2][1]), (51, rows[2][1]), (52, shared[0] + " " + words(rng, 20) + " " + shared[0]), (53, None), (54, ""),
             (55, "And " * 4000), (56, "And " * 300), (57, "x" * 5000)]
    return rows, shared


def test_passages_equal_brute_force(spark):
    rows, _ = _rows()
    got = G.repeated_passages(documents(spark, rows).repartition(4)).collect()
    assert sorted(map(tuple, got)) == _brute(rows)


def test_passages_of_just_over_50_words_are_caught_to_their_ends():
    rng = random.Random(4)
    exact = 0
    for _ in range(300):
        passage = words(rng, 51)
        a, b = (words(rng, 40) + " " + passage + " " + words(rng, 40) for _ in range(2))
        found = _brute([(1, a), (2, b)])
        assert len(found) == 1 and passage.encode() in b.encode()[found[0][1]:found[0][2]]
        exact += found[0][3] <= len(passage) + 8
    assert exact >= 290
    assert _brute([(i, words(rng, 300)) for i in range(100)]) == []
    short = [(i, words(rng, 40) + " " + "one line of a licence that many documents share but that is no passage " + words(rng, 40)) for i in range(9)]
    assert _brute(short) == []


def test_whole_words():
    raw = "ab cd  ef\ngh".encode()
    for s in range(len(raw) + 1):
        for e in range(s, len(raw) + 1):
            want = sum(1 for m in re.finditer(rb"\S+", raw) if s <= m.start() and m.end() <= e)
            assert G.whole_words(raw, s, e) == want, (s, e)


def test_rows_of_one_id_and_without_an_id(spark):
    rng = random.Random(5)
    a, b, passage = words(rng, 100), words(rng, 100), words(rng, 150)
    rows = [(1, a), (1, a), (None, b), (9, b), (None, passage + " " + words(rng, 90)), (None, words(rng, 90) + " " + passage),
            (4, passage + " x " + words(rng, 80)), (4, words(rng, 80) + " y " + words(rng, 60))]
    docs = documents(spark, rows)
    got = G.repeated_passages(docs).collect()
    assert sorted((r.doc_id or 0, r.first_doc_id) for r in got) == [(0, None), (4, None), (9, None)]
    assert all(r.n_bytes >= len(passage) or r.doc_id == 9 for r in got)
    kept = sorted(r.text for r in G.without_repeats(docs).collect())
    assert len(kept) == 8 and kept.count(a) == 2 and rows[7][1] in kept     # a row loses its own passages only
    assert sum(passage in t for t in kept) == 1
    assert G.repeated_passages(documents(spark, [])).collect() == []


def test_very_many_equal_rows_and_clashing_names(spark):
    rng = random.Random(6)
    passage = words(rng, 80)
    rows = [(None, passage)] * 500 + [(3, passage + " " + words(rng, 40)), (2, None), (5, "")]
    docs = documents(spark, rows).repartition(5).select("*", *[F.lit(c).alias(c) for c in ("row", "runs", "_d", "start", "_c0", "doc id")])
    assert [(r.doc_id, r.first_doc_id, r.n_bytes) for r in G.repeated_passages(docs).collect()] == [(3, None, len(passage))]
    out = G.without_repeats(docs)
    assert out.columns == docs.columns and out.count() == 503
    assert {(r.doc_id, r["row"], r["doc id"]) for r in out.collect()} == {(None, "row", "doc id"), (3, "row", "doc id"), (2, "row", "doc id"), (5, "row", "doc id")}


def test_query_equals_brute_force(spark, scratch):
    rows, _ = _rows()
    documents(spark, rows).repartition(3).write.parquet(f"{scratch}/documents.parquet")
    assert sorted(map(tuple, op1_substring_dedup(spark, scratch).collect())) == _brute(rows)


def test_removal_keeps_the_first(spark):
    rows, shared = _rows()
    docs = documents(spark, rows)
    left = {r.doc_id: r.text for r in G.without_repeats(docs).collect()}
    assert set(left) == {d for d, _ in rows} and left[53] is None and left[54] == ""
    texts = dict(rows)
    assert left[0] == texts[0] and left[50] == left[51] == ""
    assert len(left[52]) < len(texts[52]) - 300
    assert G.without_repeats(docs).columns == docs.columns
