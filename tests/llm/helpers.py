"""Brute-force versions of the operators, and small tables to run them on."""

from __future__ import annotations

import random

import numpy as np
import xxhash

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, rows):
    """A documents table of (doc_id, text) or (doc_id, text, source) rows."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "src0", len(r[1] or "")) for r in rows]
    return spark.createDataFrame(full, DOCS)


def words(rng: random.Random, n: int, vocabulary: int = 4000) -> str:
    return " ".join(f"{rng.choice('bcdfgklmnprstvw')}{rng.choice('aeiou')}{rng.randrange(vocabulary):x}" for _ in range(n))


def components(ids, near):
    """The smallest id that each id reaches; ``near(i, j)`` tells links."""
    low = dict(zip(range(len(ids)), ids, strict=True))
    changed = True
    links = [(i, j) for i in range(len(ids)) for j in range(i) if near(i, j)]
    while changed:
        changed = False
        for i, j in links:
            m = min(low[i], low[j])
            if low[i] != m or low[j] != m:
                low[i] = low[j] = m
                changed = True
    return [low[i] for i in range(len(ids))]


def simhash(text: str | None) -> int:
    """As the contract says it, bit by bit."""
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    tokens, word = [], ""
    for c in lowered + " ":
        if c in " \t\n\x0b\x0c\r":
            if word:
                tokens.append(word)
            word = ""
        else:
            word += c
    if not tokens:
        return 0
    grams = [tokens] if len(tokens) < 3 else [tokens[i:i + 3] for i in range(len(tokens) - 2)]
    hashes = [xxhash.xxh64(" ".join(g).encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def cosine_links(vectors, least=0.95):
    """(number of links, smallest id reached) of each (id, vector)."""
    good = [(i, np.array(v, float)) for i, v in vectors
            if v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)]

    def near(i, j):
        a, b = good[i][1], good[j][1]
        return len(a) == len(b) and a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= least

    ids = [i for i, _ in good]
    names = components(ids, near)
    out = {i: (0, i) for i, _ in vectors}
    for k, i in enumerate(ids):
        out[i] = (sum(near(k, j) for j in range(len(good)) if j != k), names[k])
    return out


def edit_distance_region(pattern: str, text: str) -> int:
    """Fewest edits between ``pattern`` and any part of ``text``."""
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        new = [i]
        for j, t in enumerate(text, 1):
            new.append(min(row[j - 1] + (p != t), row[j] + 1, new[j - 1] + 1))
        row = new
    return min(row)
