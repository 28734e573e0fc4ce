"""Hard negatives, the prefix trie and quality rules against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from signalbarn.llm import negatives as N
from signalbarn.llm import quality as Q
from signalbarn.llm.oracle import LLM_SQL
from signalbarn.llm.queries import LLM_QUERIES
from signalbarn.llm.trie import prefix_trie, screened, rebuilt_prefixes
from tests.conftest import SF_CHECK, plan_text

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.mark.parametrize("name", sorted(LLM_SQL))
def test_results_equal_sql(spark, name):
    found = LLM_QUERIES[name](spark, SF_CHECK)
    own = duckdb.connect()
    for t in ("embeddings", "conversations", "documents", "benchmark", "pages"):
        own.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_CHECK}/{t}.parquet'")
    told = own.execute(LLM_SQL[name])
    columns = [c[0] for c in told.description]
    assert sorted(columns) == sorted(found.columns)
    as_text = lambda rows: sorted(tuple(map(str, r)) for r in rows)
    assert as_text(found.select(*columns).collect()) == as_text(told.fetchall())


# --- hard negatives


def brute_negatives(rows, every, positives=5, negatives=10):
    def fits(v):
        return v is not None and all(x is not None and np.isfinite(x) for x in v)

    own = {(i, lab, tuple(v)) for i, lab, v in rows if i is not None and lab is not None and fits(v)}
    own = sorted((i, lab, [int(np.floor(256.0 * x)) for x in v]) for i, lab, v in own)
    out = Counter()
    for i, lab, v in own:
        if i % every:
            continue
        score = [(-max(-(2**63) + 1, min(2**63 - 1, sum(a * b for a, b in zip(v, w)))), j, m) for j, m, w in own if j != i and len(w) == len(v)]
        for p, j, _ in sorted(s for s in score if s[2] == lab)[:positives]:
            inside = sorted(s for s in score if s[2] != lab and 30 * -p <= 100 * -s[0] <= 90 * -p)
            out.update((i, j, r + 1, n, -p, -s) for r, (s, n, _) in enumerate(inside[:negatives]))
    return out


VECTORS = "vec_id long, label int, embedding array<double>, score string, shard int, key int, positive int"


def vectors(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 2, 3) for r in rows], VECTORS)


def negative_rows(seed, n=400, size=6):
    rng = random.Random(seed)
    rows = [(i, rng.randrange(3), [rng.choice([0.0, 0.25, 0.5, -0.1, rng.random()]) for _ in range(size)]) for i in range(n)]
    rows += rows[:40]  # repeated rows
    rows += [(7, 1, [0.5] * size), (10, 2, [0.25] * size), (10, 0, [0.25] * size)]  # ids with different rows
    rows += [(500 + i, i % 3, [0.0] * size) for i in range(30)]  # ties at a score of zero
    rows += [(600, 0, []), (601, 1, []), (602, 1, [0.5]), (610, 1, [0.25])]
    rows += [(None, 1, [0.5] * size), (620, None, [0.5] * size), (621, 1, None), (622, 1, [None] * size), (623, 1, [float("nan")] * size), (630, 1, [float("inf")] * size)]
    return rows


@pytest.mark.parametrize("shard_rows, block_anchors", [(8192, 1024), (100, 7)])
def test_negatives_equal_brute_force(spark, monkeypatch, shard_rows, block_anchors):
    monkeypatch.setattr(N, "LEAST_SHARD", min(N.LEAST_SHARD, shard_rows))
    rows = negative_rows(3)
    found = N.hard_negatives(vectors(spark, rows), F.col("vec_id") % 10 == 0, shard_rows=shard_rows, block_anchors=block_anchors)
    assert Counter(map(tuple, found.collect())) == brute_negatives(rows, 10)


def test_negatives_of_extreme_vectors_and_of_nothing(spark):
    rows = [(0, 1, [1e200, 1.0]), (1, 1, [1e200, 2.0]), (2, 0, [1e100, 0.0]), (3, 0, [1e-200, 5.0]), (4, 1, [3e15, 0.0]), (10, 1, [2e15, 1.0])]
    found = N.hard_negatives(vectors(spark, rows), F.col("vec_id") % 10 == 0)
    assert Counter(map(tuple, found.collect())) == brute_negatives(rows, 10)
    assert N.hard_negatives(vectors(spark, []), F.col("vec_id") % 10 == 0).count() == 0


def test_negatives_are_sorted_once_by_anchor(spark):
    keys = spark.createDataFrame([], "key binary, positive boolean")
    text = plan_text(N.stream_windows(keys))
    assert text.count("Exchange hashpartitioning(substring(key") == 1 and text.index("MapInPandas") < text.index("Sort [key")


# --- the prefix trie


def brute_trie(rows, family=20, most=4):
    turns = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            said = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()
            turns[c].append((turn is not None, turn or 0, said, role, text))
    own = {c: [t[3:] for t in sorted(x)] for c, x in turns.items()}
    rebuilt = {}
    for c in own:
        base = c - int(np.fmod(c, family))
        h = zlib.crc32(str(c).encode()) % most
        rebuilt[c] = tuple(own.get(base, [])[:h] + own[c][h:])
    members = defaultdict(list)
    for c, t in rebuilt.items():
        for d in range(len(t) + 1):
            members[t[:d]].append(c)
    out = []
    for node, convs in members.items():
        below = [n for n in members if n[: len(node)] == node]
        children = [n for n in below if len(n) == len(node) + 1]
        leaves = [n for n in below if not any(len(m) == len(n) + 1 and m[: len(n)] == n for m in below)]
        saved = sum((len(members[n]) - 1) * len(WORD.findall(n[-1][1])) for n in below if n)
        ends = ",".join(map(str, sorted(c for c in convs if rebuilt[c] == node)))
        parent = min(members[node[:-1]]) if node else None
        out.append((min(convs), len(node), parent, len(convs), len(children), len(leaves), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=lambda r: r[:2])


TURNS = "conv_id long, turn long, role string, text string, depth int, d1 string, base int, words string"


def turn_rows(seed):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(-45, 200), 130):
        for turn in range(rng.randrange(1, 7)):
            rows.append((c, turn, ("user", "assistant")[turn % 2], rng.choice(["a", "b b", " c\td  e "])))
    rows += [(300, t, "user", f"long {t}") for t in range(60)]
    rows += [(301, t, "user", f"long {t}") for t in range(60)]
    rows += [(320, None, None, None), (320, 1, "x", "same"), (320, 1, "x", "same"), (320, 1, "w", "same"), (None, 0, "user", "nobody")]
    rows += [(c, t, "user", "very common") for c in range(400, 460) for t in range(3)]  # a group of copies
    return rows


@pytest.mark.parametrize("width", [None, 4])
def test_trie_equals_brute_force(spark, width):
    """With four cells a row the sketch proves nothing, and every prefix is grouped exactly."""
    rows = turn_rows(5)
    df = spark.createDataFrame([(*r, 1, "x", 2, "y") for r in rows], TURNS).repartition(7)
    found = sorted(map(tuple, prefix_trie(df, width=width).collect()), key=lambda r: r[:2])
    assert found == brute_trie(rows)


def test_trie_of_turnless_conversations_and_of_nothing(spark):
    c = next(c for c in range(1, 20) if zlib.crc32(str(c).encode()) % 4 > 1)  # its base is absent and it has one turn
    df = spark.createDataFrame([(c, 0, "user", "x")], TURNS.split(", depth")[0])
    assert [tuple(r) for r in prefix_trie(df).collect()] == brute_trie([(c, 0, "user", "x")])
    assert prefix_trie(df.limit(0)).count() == 0


def test_a_prefix_proven_alone_is_alone(spark):
    df = spark.createDataFrame([(*r, 1, "x", 2, "y") for r in turn_rows(8)], TURNS)
    marked = screened(rebuilt_prefixes(df), 256).toPandas()
    sizes = marked.groupby(["d1", "d2"])["conv_id"].transform("size")
    assert marked["alone"].any() and not (marked["alone"] & (sizes > 1)).any()


# --- quality rules


def brute_measures(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    twice = {j for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for j in range(i, i + 5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    failed = len(words) < 10 or 100 * len(twice) > 20 * len(words)
    return len(words), sum(map(len, words)), sum(c in Q.SYMBOLS for c in text), len(lines) - len(set(lines)), len(twice), failed


def quality_rows():
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdeéñ") for _ in range(rng.randrange(2, 9)))
    prose = lambda n: ".\n".join(" ".join(word() for _ in range(12)) for _ in range(n)) + "."
    rows = [(i, prose(rng.randrange(6, 30))) for i in range(300)]
    rows += [(1000 + i, " ".join(word() + "&&&" * 2 + "%%%" for _ in range(100))) for i in range(30)]
    rows += [(2000 + i, prose(6) + "\n" + "\n".join(["the same line of words here"] * i)) for i in range(30)]
    rows += [(3000, None), (3001, ""), (3002, " \n\t\x0b\x0c\r "), (None, prose(8)), (None, None), (3003, "one"), (3004, "a b c d e"), (3005, "a a a a a a a a a a a a")]
    rows += [(3006, "x y z v w x y z v w x y z v w q"), (3007, "\U0001f600 ünï " * 40), (3008, prose(9000))]
    return rows + rows[:5]


def test_quality_measures_equal_brute_force(spark):
    rows = quality_rows()
    df = spark.createDataFrame([(*r, 1, "x", True) for r in rows], "doc_id long, text string, n_words int, kept string, quality boolean")
    found = Q.judge_quality(df).collect()
    got = Counter(tuple(r)[:7] for r in found)
    assert got == Counter((i, *brute_measures(t)) for i, t in rows)
    kept = {r["doc_id"]: r["kept"] for r in found}
    assert all(kept[i] for i in range(300)) and not any(kept[1000 + i] for i in range(30))
    assert not any(r["kept"] and r["base_failed"] for r in found)
    assert Q.judge_quality(df.limit(0)).count() == 0


def test_quality_is_the_posterior_of_the_votes(spark):
    """The column expression against Bayes' rule, and the estimate against rules of known accuracy."""
    rng = random.Random(1)
    accuracy = [0.95, 0.9, 0.8, 0.7, 0.6]
    counts = Counter()
    for _ in range(20_000):
        good = rng.random() < 0.8
        counts[tuple(0 if rng.random() < 0.3 else (1 if (rng.random() < a) == good else -1) for a in accuracy)] += 1
    model = Q.estimate(sorted(counts.items()), 5)
    assert abs(model.good - 0.8) < 0.03
    assert all(abs(x - a) < 0.05 for x, a in zip(model.right_on_good, accuracy))
    df = spark.createDataFrame([(*r,) for r in quality_rows()], "doc_id long, text string")
    measured = Q.measures(df)
    own = Q.fit_votes(measured)
    names = [r.name for r in Q.RULES]
    for r in measured.select(Q.quality(measured, own).alias("p"), *[r.vote() for r in Q.RULES]).distinct().collect():
        good, bad = own.good, 1 - own.good
        for v, a, b in zip((r[n] for n in names), own.right_on_good, own.right_on_bad):
            good, bad = (good * a, bad * (1 - b)) if v > 0 else (good * (1 - a), bad * b) if v < 0 else (good, bad)
        assert r["p"] == pytest.approx(good / (good + bad), abs=1e-9)


def test_quality_runs_no_python_workers(spark):
    text = plan_text(Q.measures(spark.createDataFrame([(1, "a b")], "doc_id long, text string")))
    assert "Python" not in text and "Pandas" not in text and "Exchange" not in text
