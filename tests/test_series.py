"""Counters, running totals and quantiles, also against brute force on skewed data."""

import math
import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from signalbarn.functions.quantiles import exact_quantiles, part_of_range, value_range
from signalbarn.functions.series import previous_point, running_total
from signalbarn.operators import metrics as M

SEC = 1_000_000_000


def points(spark, rows, temporality=2, monotonic=True):
    """rows: (service, series, time in s, start in s, value)"""
    data = [(s, "m", k, t * SEC, st * SEC, float(v)) for s, k, t, st, v in rows]
    df = spark.createDataFrame(
        data,
        "ServiceName string, MetricName string, SeriesKey string, TimeUnixNanos bigint, "
        "StartTimeUnixNanos bigint, Value double",
    )
    return df.withColumns(
        {
            "StartTimeUnix": F.timestamp_seconds(F.expr("StartTimeUnixNanos div 1000000000")),
            "AggregationTemporality": F.lit(temporality),
            "IsMonotonic": F.lit(monotonic),
        }
    )


def by_time(df, column):
    return [r[column] for r in df.orderBy("SeriesKey", "TimeUnixNanos").collect()]


def test_increase_with_resets(spark):
    rows = [
        ("a", "x", 0, 0, 5),
        ("a", "x", 10, 0, 8),
        ("a", "x", 1200, 0, 20),  # another slice
        ("a", "x", 1210, 0, 4),  # value falls: reset
        ("a", "x", 5000, 4000, 9),  # start changes: reset although the value grew
        ("a", "y", 7, 0, 100),
    ]
    out = M.counter_increase(points(spark, rows))
    assert by_time(out, "Increase") == [0, 3, 12, 4, 9, 0]
    rates = by_time(M.counter_rate(points(spark, rows)), "Rate")
    assert rates[0] is None and rates[5] is None
    assert rates[1] == pytest.approx(0.3)
    assert rates[2] == pytest.approx(12 / 1190)


def test_increase_leaves_out_other_points(spark):
    rows = [("a", "x", 0, 0, 5), ("a", "x", 1, 0, 6)]
    assert M.counter_increase(points(spark, rows, temporality=1)).count() == 0
    assert M.counter_increase(points(spark, rows, monotonic=False)).count() == 0


def test_nonmonotonic_delta_may_fall(spark):
    rows = [("a", "x", 0, 0, 5), ("a", "x", 1, 0, 2)]
    out = M.cumulative_to_delta(points(spark, rows, monotonic=False))
    assert by_time(out, "Value") == [5, -3]


def test_delta_roundtrip(spark):
    rng = random.Random(1)
    rows = [
        ("a", f"k{i % 3}", i * 97, 0, rng.randint(0, 50)) for i in range(300)
    ]
    deltas = points(spark, rows, temporality=1)
    back = M.cumulative_to_delta(M.delta_to_cumulative(deltas))
    assert by_time(back, "Value") == by_time(deltas, "Value")


def test_sum_total_mixes_temporalities(spark):
    delta = points(spark, [("a", "x", 1, 0, 5), ("a", "x", 2, 0, 6)], temporality=1)
    cumulative = points(spark, [("a", "y", 1, 0, 10), ("a", "y", 2, 0, 17)])
    (row,) = M.sum_total(delta.unionByName(cumulative), ["ServiceName"]).collect()
    assert row.total == 18


@pytest.mark.parametrize("width", [timedelta(seconds=5), timedelta(hours=1)])
def test_hot_series_against_brute_force(spark, width):
    """One series holds most rows; ties on time are broken by the value."""
    rng = random.Random(2)
    rows = []
    for i in range(2000):
        key = "hot" if rng.random() < 0.7 else f"k{rng.randint(0, 20)}"
        rows.append((key, rng.randint(0, 900), rng.randint(0, 10**6)))
    df = spark.createDataFrame(rows, "key string, second bigint, v bigint").withColumn(
        "t", F.col("second") * SEC
    )
    before = previous_point(df, ["key"], "t", ["t", "v"], ["t", "v"], "prev", width)
    total = running_total(df, ["key"], "t", ["t", "v"], "v", "total", slice_width=width)
    got_prev = sorted(
        (r.key, r.second, r.v, -1 if r.prev is None else r.prev.v) for r in before.collect()
    )
    got_total = sorted((r.key, r.second, r.v, r.total) for r in total.collect())
    want_prev, want_total, last, sums = [], [], {}, {}
    for key, second, v in sorted(rows):
        want_prev.append((key, second, v, last.get(key, -1)))
        sums[key] = sums.get(key, 0) + v
        want_total.append((key, second, v, sums[key]))
        last[key] = v
    assert got_prev == sorted(want_prev)
    assert got_total == sorted(want_total)


def test_value_range_keeps_order(spark):
    rng = random.Random(3)
    values = sorted({0, 1, 2, 2047, 2048, 4095, 4096, 2**62, *(rng.getrandbits(rng.randint(1, 62)) for _ in range(2000))})
    df = spark.createDataFrame([(v,) for v in values], "v bigint")
    got = [r[0] for r in df.orderBy("v").select(value_range(F.col("v"))).collect()]
    assert got == sorted(got)


def test_exact_quantiles_against_sort(spark):
    rng = random.Random(4)
    rows = []
    for i in range(6000):
        group = "hot" if rng.random() < 0.6 else f"g{rng.randint(0, 9)}"
        rows.append((group, int(rng.lognormvariate(14, 3))))
    rows += [("same", 7)] * 50 + [("one", 123456789)] + [("none", None)] * 3
    df = spark.createDataFrame(rows, "g string, v bigint")
    qs = {"p0": "0", "p50": "0.5", "p95": "0.95", "p99": "0.99", "p100": "1"}
    out = exact_quantiles(
        df, ["g"], "v", qs, {"n": (F.count(F.lit(1)), F.sum("n")), "hi": (F.max("v"), F.max("hi"))}
    )
    got = {r.g: r for r in out.collect()}
    assert set(got) == {g for g, _ in rows}
    for g, row in got.items():
        values = sorted(v for k, v in rows if k == g and v is not None)
        assert row.n == sum(1 for k, _ in rows if k == g)
        if not values:
            assert row.p50 is None and row.hi is None
            continue
        assert row.hi == values[-1]
        for name, q in qs.items():
            rank = max(1, math.ceil(round(float(q) * len(values), 9)))
            assert row[name] == values[rank - 1], (g, name)


def test_part_of_range_keeps_order(spark):
    rng = random.Random(5)
    values = sorted({0, 1, 5, 2**62, *(rng.getrandbits(rng.randint(1, 62)) for _ in range(2000)), *range(10**12, 10**12 + 500)})
    both = F.struct(value_range(F.col("v")), part_of_range(F.col("v"), value_range(F.col("v"))))
    got = [r[0] for r in spark.createDataFrame([(v,) for v in values], "v bigint").orderBy("v").select(both).collect()]
    assert got == sorted(got)


def test_quantiles_of_a_hot_range(spark):
    """A third of the rows differ by less than 0.07 %; no task orders more than a few of their values."""
    hot, other = 20_000, 40_000
    df = spark.range(hot + other).selectExpr(
        "'g' AS g", f"CASE WHEN id < {hot} THEN 1000000000 + id * 30 ELSE (id * 7919) % 900000000 END AS v"
    )
    values = sorted(r.v for r in df.collect())
    qs = {"p50": "0.5", "p70": "0.7", "p80": "0.8", "p99": "0.99"}
    (got,) = exact_quantiles(df, ["g"], "v", qs).collect()
    for name, q in qs.items():
        assert got[name] == values[math.ceil(round(float(q) * len(values), 9)) - 1]
    ranged = df.withColumn("r", value_range(F.col("v"))).withColumn("p", part_of_range(F.col("v"), F.col("r")))
    per_range = ranged.groupBy("r").agg(F.count_distinct("v").alias("n")).agg(F.max("n")).first()[0]
    per_part = ranged.groupBy("r", "p").agg(F.count_distinct("v").alias("n")).agg(F.max("n")).first()[0]
    assert per_range > 15_000 and per_part < 100


def test_latest_and_trend(spark):
    rows = [("a", "x", 1, 0, 5), ("a", "x", 9, 0, 1), ("a", "y", 3, 0, 2), ("a", "x", 70, 0, 4)]
    df = points(spark, rows, temporality=0)
    assert by_time(M.latest_per_series(df), "Value") == [4, 2]
    trend = M.metric_trend(df, timedelta(minutes=1)).orderBy("SeriesKey", "BucketNanos").collect()
    assert [(r["count"], r["sum"], r["min"], r["max"], r["last"]) for r in trend] == [
        (2, 6, 1, 5, 1),
        (1, 4, 4, 4, 4),
        (1, 2, 2, 2, 2),
    ]


def test_cardinality(spark):
    rows = [("a", f"k{i % 50}", i, 0, 1) for i in range(200)]
    df = points(spark, rows)
    assert M.series_cardinality(df).first().series == 50
    assert abs(M.series_cardinality(df, approximate=True).first().series - 50) <= 5


def test_series_key_ignores_order(spark):
    df = spark.sql("SELECT map('a','1','b','2') AS Attributes UNION ALL SELECT map('b','2','a','1')")
    assert M.with_series_key(df).select("SeriesKey").distinct().count() == 1


def test_series_sketches_merge(spark):
    rows = [("a", f"k{i % 5000}", 86400 * (i % 3) + i, 0, 1) for i in range(15000)]
    df = points(spark, rows).withColumn("TimeUnix", F.timestamp_seconds(F.expr("TimeUnixNanos div 1000000000")))
    daily = M.series_sketches(df)
    assert daily.count() == 3
    (whole,) = M.series_of_sketches(daily, ["ServiceName", "MetricName"]).collect()
    assert abs(whole.series - 5000) < 150
    again = M.series_of_sketches(daily.unionByName(daily), ["ServiceName", "MetricName"]).first()
    assert again.series == whole.series
