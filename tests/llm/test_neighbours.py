import math
import random

import numpy as np
import pytest

from signalbarn.llm.neighbours import nearest


def vectors():
    rng = np.random.default_rng(3)
    base = rng.normal(size=(20, 16))
    rows = [(i, (base[i % 20] * (0.5 + i % 3) + rng.normal(size=16) * (0.1 if i % 4 else 2)).astype(np.float32).tolist()) for i in range(1200)]
    rows += [(2000 + i, rows[5][1]) for i in range(300)]  # one very common vector
    rows += [(3000, None), (3020, [0.0] * 16), (3040, [float("nan")] + [1.0] * 15), (3060, [None] + [1.0] * 15), (3080, [float("inf")] * 16), (3100, [1.0, 2.0]), (3101, [1.0, 0.5]), (None, [1.0] * 16), (20, rows[20][1]), (3200, [1.0] * 5)]
    return rows


def brute(rows, every=20, k=20):
    seen = {(i, tuple(v)) for i, v in rows if i is not None and v and None not in v and all(map(math.isfinite, v)) and any(v)}
    out = {}
    for q, v in seen:
        if q % every == 0:
            near = sorted((-math.fsum(a * b for a, b in zip(v, w)), j) for j, w in seen if j != q and len(w) == len(v))
            out[q] = [(q, n + 1, j, -s) for n, (s, j) in enumerate(near[:k])]
    return out


def test_recall_and_order(spark):
    rows = vectors()
    random.Random(1).shuffle(rows)
    frame = spark.createDataFrame([(*r, 1.0) for r in rows], "vec_id long, embedding array<float>, score double")
    want = brute([(r.vec_id, r.embedding) for r in frame.collect()])
    for size in (100_000, 400):
        got = {}
        for r in nearest(frame, shard_rows=size, block_rows=30).orderBy("query_id", "rank").collect():
            got.setdefault(r.query_id, []).append(tuple(r))
        hit = sum(len({x[2] for x in got.get(q, [])} & {x[2] for x in w}) for q, w in want.items())
        assert hit >= 0.95 * sum(map(len, want.values()))
        assert set(got) == {q for q, w in want.items() if w}
        for q, w in want.items():
            mine = got.get(q, [])
            assert [x[1] for x in mine] == list(range(1, len(w) + 1))
            assert mine == sorted(mine, key=lambda x: (-x[3], x[2])) and q not in {x[2] for x in mine}


def test_empty(spark):
    assert nearest(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_copies_take_no_places(spark):
    rng = np.random.default_rng(5)
    same = rng.normal(size=8).tolist()
    rows = [(20, same)] + [(1, same)] * 25 + [(i, same) for i in range(2, 6)]
    got = nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), every=20, k=20).collect()
    assert sorted((r.rank, r.vec_id) for r in got) == [(i, i) for i in range(1, 6)]
    # an id with many vectors, all nearer to each other than other ids are
    rows = [(20, (np.array(same) * 9 + rng.normal(size=8) * 0.01).tolist()) for _ in range(40)]
    rows += [(i, rng.normal(size=8).tolist()) for i in range(1, 19)]
    got = nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), every=20, k=5).collect()
    assert [r.rank for r in sorted(got, key=lambda r: r.rank)] == [1, 2, 3, 4, 5] and 20 not in {r.vec_id for r in got}


@pytest.mark.parametrize("data", ["sf0.01", "sf0.1"])
def test_recall_on_given_tables(spark, data):
    frame = spark.read.parquet(f"/root/testdata/{data}/embeddings.parquet")
    want = brute([(r.vec_id, r.embedding) for r in frame.collect()])
    got = {}
    for r in nearest(frame).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    recalls = [len(got.get(q, set()) & {x[2] for x in w}) / len(w) for q, w in want.items()]
    assert sum(recalls) / len(recalls) >= 0.97 and min(recalls) >= 0.8


def test_exact_search_misses_nothing(spark):
    rows = vectors()
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    want = brute([(r.vec_id, r.embedding) for r in frame.collect()])
    got = {}
    for r in nearest(frame, shard_rows=300, block_rows=20, exact=True).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(tuple(r))
    assert got == {q: w for q, w in want.items() if w}


def test_extreme_values(spark):
    big, small = 1e200, 1e-200
    rows = [(0, [big, big]), (1, [big, -big]), (2, [small, small]), (3, [1.0, 2.0]), (20, [small, 0.0]), (40, [1.7e308, 1.7e308]), (41, [-1.7e308, 1.0])]
    found = nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), exact=True).collect()
    scores = {(r.query_id, r.vec_id): r.score for r in found}
    assert len(scores) == 3 * 6
    assert scores[0, 40] == scores[40, 0] == 1.7976931348623157e308 and scores[40, 41] == -1.7976931348623157e308
    assert scores[0, 1] == 0.0 and scores[20, 3] == 1e-200
    assert len(nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()) == 18
