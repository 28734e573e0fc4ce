import random

import numpy as np
import pytest
import xxhash

from signalbarn.llm import simhash
from signalbarn.llm.simhash import fingerprint, keep_first, links, simhash_groups


def plain_fingerprint(text, k=3):
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0d]+", text or "") if w]
    words = ["".join(c.lower() if "A" <= c <= "Z" else c for c in w) for w in words]
    grams = [" ".join(words[i : i + k]) for i in range(len(words) - k + 1)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(points, bits):
    root = list(range(len(points)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(points)):
        for j in range(i):
            if bin(points[i] ^ points[j]).count("1") <= bits:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(points))]


@pytest.mark.parametrize("text", [None, "", " \t", "one", "One TWO", "ÄÖ äö A", "a b c d e f g", "x " * 500 + "\x0b y\x85z"])
def test_fingerprint(text, monkeypatch):
    assert fingerprint(text) == plain_fingerprint(text)
    monkeypatch.setattr(simhash, "CHUNK", 7)
    assert fingerprint(text) == plain_fingerprint(text)


def planted(n, seed, centres=6, flips=6):
    rng = random.Random(seed)
    base = [rng.getrandbits(64) for _ in range(centres)]
    out = {rng.getrandbits(64) for _ in range(n // 2)}
    while len(out) < n:
        p = rng.choice(base)
        for _ in range(rng.randrange(flips)):
            p ^= 1 << rng.randrange(64)
        out.add(p)
    return sorted(out)


@pytest.mark.parametrize("leaf", [8, 64])
def test_links_are_exact(leaf, monkeypatch):
    monkeypatch.setattr(simhash, "LEAF", leaf)
    points = planted(1200, leaf)
    a, b = links(np.array(points, np.uint64), 2)
    assert all(bin(points[i] ^ points[j]).count("1") <= 64 for i, j in zip(a, b))
    root = list(range(len(points)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in zip(a, b):
        x, y = find(i), find(j)
        root[max(x, y)] = min(x, y)
    assert [find(i) for i in range(len(points))] == plain_components(points, 2)


def test_groups(spark, monkeypatch):
    monkeypatch.setattr(simhash, "SHARD", 20)
    rng = random.Random(3)
    words = ["w%d" % i for i in range(300)]
    rows = []
    for i in range(160):
        text = " ".join(rng.choice(words) for _ in range(rng.randrange(1, 200)))
        rows.append((1000 - i, text, i))
        for c in range(rng.randrange(3)):
            parts = text.split()
            if c:
                parts[rng.randrange(len(parts))] = "x"
            rows.append((2000 + len(rows), " ".join(parts), i))
    rows += [(5, None, 0), (6, "", 0), (5, None, 0), (None, "", 0), (None, "lonely words here", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp int")
    got = sorted(((r.doc_id, r.fingerprint, r.component_id) for r in simhash_groups(docs).collect()), key=str)
    prints = [plain_fingerprint(t) for _, t, _ in rows]
    roots = plain_components(prints, 2)
    least = {}
    for (i, _, _), r in zip(rows, roots):
        if i is not None:
            least[r] = min(i, least.get(r, i))
    assert got == sorted(((i, f"{p:016x}", least.get(r)) for (i, _, _), p, r in zip(rows, prints, roots)), key=str)
    kept = keep_first(docs, simhash_groups(docs))
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == sorted(set(least.values()))
    assert kept.columns == docs.columns


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert simhash_groups(docs).count() == 0
    assert keep_first(docs, simhash_groups(docs)).count() == 0


def test_keep_first_tells_texts_of_an_id_apart(spark):
    near, far, lone = "a b c d e f g h", "nothing like it at all in here", "words of no other text whatsoever"
    assert plain_fingerprint(near) == plain_fingerprint(near.upper())
    rows = [(1, near), (5, near.upper()), (5, far), (7, lone), (7, near + " zz" * 9), (7, lone), (None, "same"), (None, "same"), (None, "other"), (None, far)]
    docs = spark.createDataFrame([(*r, n) for n, r in enumerate(rows)], "doc_id long, text string, n int")
    want = {(1, near), (5, far), (7, lone), (7, near + " zz" * 9), (None, "same"), (None, "other")}
    roots = plain_components([plain_fingerprint(t) for _, t in rows], 2)
    assert len(set(roots)) == len(want)
    kept = keep_first(docs, simhash_groups(docs))
    assert kept.columns == docs.columns
    got = [(r.doc_id, r.text) for r in kept.collect()]
    assert len(got) == len(want) and set(got) == want
