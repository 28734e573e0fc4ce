"""Histogram operators on hand-made rows."""

import math
import random

import pytest
from pyspark.sql import functions as F

from signalbarn.operators import histograms as H
from signalbarn.operators import metrics as M

HIST = (
    "g string, Count bigint, Sum double, BucketCounts array<bigint>, ExplicitBounds array<double>, "
    "Min double, Max double"
)
EXP = (
    "g string, Count bigint, Sum double, Scale int, ZeroCount bigint, PositiveOffset int, "
    "PositiveBucketCounts array<bigint>, NegativeOffset int, NegativeBucketCounts array<bigint>, "
    "Min double, Max double"
)


def test_merge_keeps_layouts_apart(spark):
    rows = [
        ("a", 3, 6.0, [1, 2, 0], [1.0, 2.0], 0.5, 2.0),
        ("a", 4, 9.0, [0, 3, 1], [1.0, 2.0], None, 5.0),
        ("a", 1, 1.0, [1, 0], [10.0], 1.0, 1.0),
        ("a", 2, 5.0, [], [], None, None),
        ("b", 0, 0.0, [0, 0, 0], [1.0, 2.0], None, None),
    ]
    out = H.merge_histograms(spark.createDataFrame(rows, HIST), ["g"]).collect()
    got = {(r.g, tuple(r.ExplicitBounds)): r for r in out}
    assert len(got) == 4
    first = got[("a", (1.0, 2.0))]
    assert (first.Count, first.Sum, first.BucketCounts) == (7, 15.0, [1, 5, 1])
    assert (first.Min, first.Max) == (0.5, 5.0)
    assert got[("a", ())].Count == 2 and got[("a", ())].BucketCounts == []
    assert got[("b", (1.0, 2.0))].Min is None
    assert sum(r.Count for r in out) == sum(r[1] for r in rows)


@pytest.mark.parametrize(
    "counts, bounds, q, expected",
    [
        ([10, 0, 0], [10.0, 20.0], 0.5, 5.0),
        ([0, 10, 0], [10.0, 20.0], 0.5, 15.0),
        ([5, 5, 0], [10.0, 20.0], 0.5, 10.0),
        ([0, 0, 10], [10.0, 20.0], 0.5, 20.0),  # overflow bucket: last bound
        ([4, 0, 0], [-5.0, 0.0], 0.5, -5.0),  # first bound not positive
        ([0, 4, 0], [-5.0, 5.0], 0.5, 0.0),
        ([0, 0, 0], [10.0, 20.0], 0.5, None),
        ([3], [], 0.5, None),
        ([2, 2, 0], [10.0, 20.0], 0.0, 0.0),
        ([2, 2, 0], [10.0, 20.0], 1.0, 20.0),
    ],
)
def test_quantile(spark, counts, bounds, q, expected):
    df = spark.createDataFrame([("a", sum(counts), 0.0, counts, bounds, None, None)], HIST)
    assert H.histogram_quantile(df, q).first().Quantile == expected


def test_quantiles_are_monotone(spark):
    rng = random.Random(5)
    rows = []
    for i in range(50):
        counts = [rng.randint(0, 9) for _ in range(6)]
        rows.append((str(i), sum(counts), 0.0, counts, [1.0, 2.0, 4.0, 8.0, 16.0], None, None))
    df = spark.createDataFrame(rows, HIST)
    qs = [0.0, 0.1, 0.25, 0.5, 0.9, 0.99, 1.0]
    for i, q in enumerate(qs):
        df = H.histogram_quantile(df, q, f"q{i}")
    for r in df.collect():
        values = [r[f"q{i}"] for i in range(len(qs))]
        if r.Count:
            assert values == sorted(values)


def test_histogram_to_delta(spark):
    base = (
        "ServiceName string, MetricName string, SeriesKey string, TimeUnixNanos bigint, "
        "StartTimeUnixNanos bigint, Count bigint, Sum double, BucketCounts array<bigint>, "
        "ExplicitBounds array<double>, Min double, Max double, AggregationTemporality int"
    )
    t = 10**12  # further apart than a slice

    def row(time, start, counts, bounds=(1.0,)):
        return ("s", "m", "k", time * t, start, sum(counts), float(sum(counts)), list(counts),
                list(bounds), 1.0, 2.0, 2)

    rows = [
        row(1, 0, [1, 1]),
        row(2, 0, [3, 4]),
        row(3, 0, [3, 1]),  # falls: reset
        row(4, 9, [5, 5]),  # new start: reset
        row(5, 9, [6, 6, 1], (1.0, 2.0)),  # other bounds: reset
    ]
    df = spark.createDataFrame(rows, base)
    out = H.histogram_to_delta(df).orderBy("TimeUnixNanos").collect()
    assert [r.BucketCounts for r in out] == [[0, 0], [2, 3], [3, 1], [5, 5], [6, 6, 1]]
    assert [r.Count for r in out] == [0, 5, 4, 10, 13]
    assert all(r.Min is None and r.AggregationTemporality == 1 for r in out)
    first = H.histogram_to_delta(df, first="value").orderBy("TimeUnixNanos").first()
    assert first.BucketCounts == [1, 1] and first.Count == 2
    with pytest.raises(ValueError):
        H.histogram_to_delta(df, first="other")


# ---------------------------------------------------------------- exponential


def exp_row(g, scale, zero, pos, neg, low=None, high=None):
    """pos and neg: (offset, counts)"""
    n = zero + sum(pos[1]) + sum(neg[1])
    return (g, n, float(n), scale, zero, pos[0], pos[1], neg[0], neg[1], low, high)


def test_exp_buckets_with_zero_and_negative(spark):
    df = spark.createDataFrame([exp_row("a", 0, 3, (0, [1, 0, 2]), (-1, [4]))], EXP)
    got = sorted(tuple(r) for r in H.exp_histogram_buckets(df, ["g"]).collect())
    assert got == [
        ("a", -1.0, -0.5, 4),
        ("a", 0.0, 0.0, 3),
        ("a", 1.0, 2.0, 1),
        ("a", 4.0, 8.0, 2),
    ]


def test_exp_merge_downscales(spark):
    rows = [
        exp_row("a", 1, 1, (-3, [1, 2, 3, 4]), (0, []), 0.5, 3.0),  # indexes -3..0
        exp_row("a", 0, 2, (0, [5]), (2, [7]), 1.0, 9.0),
        exp_row("b", 2, 0, (0, []), (0, [])),
    ]
    got = {r.g: r for r in H.merge_exp_histograms(spark.createDataFrame(rows, EXP), ["g"]).collect()}
    a = got["a"]
    # index i at scale 1 is i >> 1 at scale 0: -3, -2, -1, 0 -> -2, -1, -1, 0
    assert (a.Scale, a.PositiveOffset, a.PositiveBucketCounts) == (0, -2, [1, 5, 9])
    assert (a.NegativeOffset, a.NegativeBucketCounts) == (2, [7])
    assert (a.ZeroCount, a.Count, a.Min, a.Max) == (3, 25, 0.5, 9.0)
    assert (got["b"].Count, got["b"].PositiveBucketCounts) == (0, [])


def test_exp_merge_keeps_counts(spark):
    rng = random.Random(6)
    rows = []
    for i in range(120):
        pos = (rng.randint(-40, 40), [rng.randint(0, 5) for _ in range(rng.randint(0, 12))])
        neg = (rng.randint(-40, 40), [rng.randint(0, 5) for _ in range(rng.randint(0, 6))])
        rows.append(exp_row("hot" if i % 3 else "g", rng.randint(-2, 4), rng.randint(0, 3), pos, neg))
    df = spark.createDataFrame(rows, EXP)
    for r in H.merge_exp_histograms(df, ["g"]).collect():
        mine = [x for x in rows if x[0] == r.g]
        scale = min(x[3] for x in mine)
        want = {}
        for x in mine:
            for i, n in enumerate(x[6]):
                if n:
                    k = (x[5] + i) >> (x[3] - scale)
                    want[k] = want.get(k, 0) + n
        got = {r.PositiveOffset + i: n for i, n in enumerate(r.PositiveBucketCounts) if n}
        assert (r.Scale, got) == (scale, want)
        total = r.ZeroCount + sum(r.PositiveBucketCounts) + sum(r.NegativeBucketCounts)
        assert total == r.Count == sum(x[1] for x in mine)


def test_exp_quantile_walks_all_buckets(spark):
    df = spark.createDataFrame(
        [exp_row("a", 0, 2, (0, [1, 1]), (0, [1, 1])), exp_row("e", 0, 0, (0, []), (0, []))], EXP
    )
    # values from -3 up: (-4,-2], (-2,-1], zero, zero, (1,2], (2,4]
    root = math.sqrt(2)
    for q, expected in [(0.0, -2 * root), (0.2, -root), (0.5, 0.0), (0.8, root), (1.0, 2 * root)]:
        out = {r.g: r.Quantile for r in H.exp_histogram_quantile(df, q).collect()}
        assert out["a"] == pytest.approx(expected)
        assert out["e"] is None


def dense(values, at):
    """(offset, counts) of a dict of counts, with an empty bucket on both sides."""
    return (min(values) - 1, [values.get(i, 0) for i in range(min(values) - 1, max(values) + 2)]) if values else (at, [])


def test_exp_histogram_to_delta_against_python(spark):
    """Random cumulative points of several series: growth, changes of scale, restarts and falls."""
    rng = random.Random(8)
    schema = (
        "ServiceName string, MetricName string, SeriesKey string, TimeUnixNanos bigint, StartTimeUnixNanos bigint, "
        "Count bigint, Sum double, Scale int, ZeroCount bigint, PositiveOffset int, PositiveBucketCounts array<bigint>, "
        "NegativeOffset int, NegativeBucketCounts array<bigint>, Min double, Max double, AggregationTemporality int"
    )
    rows, want = [], {}
    for series in range(12):
        scale, start, zero, sides, before = 4, 0, 0, ({}, {}), None
        for t in range(1, 9):
            event = rng.choice(["grow", "grow", "coarser", "restart", "fall", "finer"])
            if event == "restart":
                start, zero, sides = t, 0, ({}, {})
            if event in ("coarser", "finer"):
                new = scale + (-rng.randint(1, 3) if event == "coarser" else 1)
                if event == "finer":  # a finer scale starts over
                    start, zero, sides = t, 0, ({}, {})
                else:
                    moved = ({}, {})
                    for side, to in zip(sides, moved):
                        for i, n in side.items():
                            to[i >> (scale - new)] = to.get(i >> (scale - new), 0) + n
                    sides = moved
                scale = new
            for side in sides:
                for _ in range(rng.randint(0, 4)):
                    i = rng.randint(-30, 30)
                    side[i] = side.get(i, 0) + rng.randint(1, 5)
            zero += rng.randint(0, 2)
            if event == "fall" and sides[0]:
                key = rng.choice(list(sides[0]))
                sides[0].pop(key)
            now = (start, scale, zero, [dict(s) for s in sides])
            total = zero + sum(n for s in sides for n in s.values())
            (po, pc), (no, nc) = dense(sides[0], 0), dense(sides[1], 0)
            rows.append(("s", "m", str(series), t * 10**12, start, total, float(total), scale, zero, po, pc, no, nc, None, None, 2))
            if before is None:
                want[series, t] = (scale, 0, {}, {})
            else:
                low = min(scale, before[1])

                def at_low(state):
                    out = []
                    for s in state[3]:
                        o = {}
                        for i, n in s.items():
                            o[i >> (state[1] - low)] = o.get(i >> (state[1] - low), 0) + n
                        out.append(o)
                    return out

                a, b = at_low(now), at_low(before)
                grown = [{i: x.get(i, 0) - y.get(i, 0) for i in {*x, *y}} for x, y in zip(a, b)]
                total_before = before[2] + sum(n for s in before[3] for n in s.values())
                reset = start != before[0] or total < total_before or zero < before[2] or any(n < 0 for g in grown for n in g.values())
                clean = lambda d: {i: n for i, n in d.items() if n}
                want[series, t] = (scale, zero, *map(clean, now[3])) if reset else (low, zero - before[2], *map(clean, grown))
            before = now
    got = {}
    for r in H.exp_histogram_to_delta(spark.createDataFrame(rows, schema)).collect():
        sides = [
            {offset + i: n for i, n in enumerate(counts) if n}
            for offset, counts in ((r.PositiveOffset, r.PositiveBucketCounts), (r.NegativeOffset, r.NegativeBucketCounts))
        ]
        got[int(r.SeriesKey), r.TimeUnixNanos // 10**12] = (r.Scale, r.ZeroCount, *sides)
        assert r.AggregationTemporality == 1 and r.Count == r.ZeroCount + sum(n for s in sides for n in s.values())
    assert got == want
    first = H.exp_histogram_to_delta(spark.createDataFrame(rows, schema), first="value").filter("TimeUnixNanos = 1000000000000")
    assert first.agg(F.sum("Count")).first()[0] == sum(r[5] for r in rows if r[3] == 10**12)


def test_means_and_summaries(spark):
    df = spark.createDataFrame([("a", 2, 5.0), ("a", 3, 5.0), ("b", 0, 0.0)], "g string, Count bigint, Sum double")
    assert {r.g: r.mean for r in M.mean_from_sum_count(df, ["g"]).collect()} == {"a": 2.0, "b": None}
    points = spark.sql(
        "SELECT array(named_struct('Quantile', 0.5D, 'Value', 3D), "
        "named_struct('Quantile', 0.99D, 'Value', 9D)) AS ValueAtQuantiles"
    )
    row = M.summary_at(points, 0.99, 8.0).first()
    assert (row.AtQuantile, row.MeetsSla) == (9.0, False)
    assert M.summary_at(points, 0.9).first().AtQuantile is None
    assert points.select(F.size("ValueAtQuantiles")).first()[0] == 2
