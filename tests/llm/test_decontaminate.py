import hashlib
import random
import re

import pytest

from signalbarn.llm import common
from signalbarn.llm.decontaminate import find_contamination

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, window=13, one_in=20):
    out = []
    for doc_id, text in docs:
        w = words(text)
        hit, ids = set(), set()
        for item_id, body in items:
            v = words(body)
            n = min(window, len(v))
            grams = {tuple(v[i : i + n]) for i in range(len(v) - n + 1)} if v else set()
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in grams:
                    hit.update(range(i, i + n))
                    ids.update([item_id] if item_id is not None else [])
        sha = hashlib.sha256(",".join(sorted(map(str, ids))).encode()).hexdigest()
        out.append((doc_id, len(w), len(hit), len(ids), sha, bool(hit) and one_in * len(hit) >= len(w)))
    return sorted(out, key=str)


def planted(seed):
    rng = random.Random(seed)
    vocabulary = ["w%d" % i for i in range(40)] + ["Äb", "ñ", "7"]
    say = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    shared = say(30)
    items = [(i, say(rng.choice([13, 14, 20, 40]))) for i in range(12)]
    items += [(100, shared), (101, "x " + shared), (9, shared), (102, "only four words here"), (103, "one"), (104, None), (105, "  "), (None, say(15)), (100, say(16)), (106, say(7))]
    docs = []
    for i in range(60):
        parts = [say(rng.randrange(0, 60))]
        for _ in range(rng.randrange(3)):
            body = rng.choice(items)[1] or ""
            w = body.split()
            cut = rng.randrange(len(w)) if w else 0
            parts += [" , ".join(w[cut:]).upper() if rng.random() < 0.3 else body, say(rng.randrange(30))]
        docs.append((i, "-".join(parts)))
    docs += [(200, None), (201, ""), (202, "..."), (203, shared), (203, shared), (203, say(20)), (None, shared), (204, ("a " * 2000) + shared), (205, "w1 " * 300)]
    items.append((107, "w1 " * 20))
    return docs, items


@pytest.mark.parametrize("broadcast", [True, False])
def test_brute_force(spark, broadcast, monkeypatch):
    if not broadcast:
        monkeypatch.setattr(common.small_or_shuffled, "__defaults__", (0,))
    docs, items = planted(1)
    frame = spark.createDataFrame([(d, t, "x", i) for i, (d, t) in enumerate(docs)], "doc_id long, text string, key string, n_hit int")
    other = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, items int")
    got = find_contamination(frame, other).drop("key")
    assert got.columns == ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(docs, items)


def test_empty(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    assert [(r.n_words, r.n_hit, r.contaminated) for r in find_contamination(docs, none).collect()] == [(2, 0, False)]
    assert find_contamination(docs.limit(0), none).count() == 0
