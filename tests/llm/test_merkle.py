"""The manifest against a plain recursive tree."""

from __future__ import annotations

import random
import zlib
from collections import defaultdict
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from tagwerk.llm import merkle
from tagwerk.llm.queries import op13_merkle_manifest

from .helpers import DOCS


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def levels(digests, arity):
    out = [digests]
    while len(out[-1]) > 1:
        out.append([h(*out[-1][i:i + arity]) for i in range(0, len(out[-1]), arity)])
    return out


def lowered(text):
    return None if text is None else "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def plain(rows, arity=8, tamper=True):
    """Result rows of (doc_id, text, lang, source, n_chars) rows."""
    groups = defaultdict(list)
    for doc_id, text, lang, source, n in rows:
        own = leaf((doc_id, source, lang, n, text))
        hit = tamper and doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 == 0
        groups[lang].append((doc_id is not None, doc_id or 0, own, leaf((doc_id, source, lang, n, lowered(text))) if hit else own, doc_id))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: levels([x[2] for x in sorted(groups[g], key=lambda x: x[:4])], arity) for g in names}
    top = levels([trees[g][-1][0] for g in names], arity)
    out = []
    for k, g in enumerate(names):
        for i, (_, _, own, candidate, doc_id) in enumerate(sorted(groups[g], key=lambda x: x[:4])):
            proof, folded = "", candidate
            for tree, at in ((trees[g], i), (top, k)):
                for level in tree[:-1]:
                    run = level[at // arity * arity:][:arity]
                    before, after = "".join(run[:at % arity]), "".join(run[at % arity + 1:])
                    proof += before + after
                    folded, at = h(before, folded, after), at // arity
            root = top[-1][0]
            out.append((doc_id, own, trees[g][-1][0], root, h(proof), folded, folded == root))
    return sorted(out, key=repr)


def table(rng, n, langs):
    rows = [(rng.randrange(-500, 100_000), rng.choice(["Some Text", "lower", "Ünï", "", None, "A" * 300]) or None, rng.choice(langs),
             rng.choice(["s1", None, ""]), rng.choice([None, 3, 0])) for _ in range(n)]
    return rows + [(None, None, None, None, None), (None, "x", langs[0], None, 1), (7, "Twice", langs[0], "s", 5), (7, "Twice", langs[0], "s", 5),
                   (7, "twice", langs[0], "s", 5)]


def collected(found):
    return sorted(((r.id, r.leaf, r.subroot, r.root, r.proof_sha256, r.folded_root, r.folded_root == r.root) for r in found.collect()), key=repr)


@pytest.mark.parametrize("n, langs", [(0, ["en"]), (1, ["en", None]), (300, ["en", "", "é", "ž", None, *"abcdefghij"]), (700, ["en"])])
def test_query_equals_plain_tree(spark, scratch, n, langs):
    rows = table(random.Random(n), n, langs)
    spark.createDataFrame(rows, DOCS).repartition(3).write.parquet(f"{scratch}/documents.parquet")
    got = [tuple(r) for r in op13_merkle_manifest(spark, scratch).collect()]
    assert sorted(got, key=repr) == plain(rows)
    assert any(not r[-1] for r in got) or n < 2


@pytest.mark.parametrize("n", [16, 17, 256, 257, 600])
def test_blocks_of_blocks(spark, n):
    """Arity 2 has blocks of 16 leaves: several levels of blocks, also for the groups."""
    rows = [(i, f"t{i}", None if i % 40 == 3 else ("en" if i % 3 else f"l{i % 24:03}"), "s", 1) for i in range(n)]
    found = merkle.manifest(spark.createDataFrame(rows, DOCS), arity=2)
    assert collected(found) == plain(rows, arity=2, tamper=False)


def test_paths_verify_rows_and_reject_others(spark):
    rows = [(i, f"Text {i}", "en", "s", 1) for i in range(70)]
    found = merkle.manifest(spark.createDataFrame(rows, DOCS), with_path=True, arity=3).collect()
    for r in found:
        steps = merkle.unpacked(bytes(r.path))
        assert merkle.fold(r.leaf.encode(), steps).decode() == r.root
        assert merkle.fold(found[0].leaf.encode() if r is not found[0] else b"0" * 64, steps).decode() != r.root


def test_empty_table_and_clashing_names(spark):
    assert merkle.manifest(spark.createDataFrame([], DOCS)).collect() == []
    rows = [(i, "t", "en", "s", 1) for i in range(20)]
    docs = spark.createDataFrame(rows, DOCS)
    more = docs.select("*", *[F.lit("x").alias(c) for c in ("id", "leaf", "pos", "total", "_group", "_named", "root", "path", "_part")])
    assert collected(merkle.manifest(more)) == plain(rows, tamper=False)


def test_appender_refuses_more_than_its_height_holds():
    tree = merkle.Appender(2, 1)
    for _ in range(2):
        tree.append(merkle.Node(b"a" * 64))
    with pytest.raises(ValueError, match="height"):
        for _ in range(2):
            tree.append(merkle.Node(b"a" * 64))
