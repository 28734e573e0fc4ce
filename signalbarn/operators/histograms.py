"""Explicit and exponential histograms: merge, quantiles, buckets, deltas."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from signalbarn.functions.series import DEFAULT_SLICE, previous_point
from signalbarn.operators.metrics import SERIES, last_of_runs, with_series_key
from signalbarn.schemas import TEMPORALITY_CUMULATIVE, TEMPORALITY_DELTA


def _zero() -> Column:
    return F.lit(0).cast("bigint")


# ---------------------------------------------------------------- explicit bounds


def merge_histograms(points: DataFrame, by: list[str]) -> DataFrame:
    """Histograms added up per group and bucket layout.

    Points with different bounds are never mixed: the bounds are part of the
    group. Cumulative points count once per run; `histogram_to_delta` gives
    intervals where groups divide the time. Buckets are summed as rows, with map-side combining, and only the
    few sums of a layout are put back into an array.
    """
    keys = [*by, "ExplicitBounds"]
    # Count, Sum, Min and Max ride on the first bucket row of each point.
    head = F.coalesce(F.col("_pos"), F.lit(0)) == 0
    buckets = last_of_runs(points).select(
        *keys, "Count", "Sum", "Min", "Max", F.posexplode_outer("BucketCounts").alias("_pos", "_n")
    )
    summed = buckets.groupBy(*keys, "_pos").agg(
        F.sum("_n").alias("_n"),
        F.sum(F.when(head, F.col("Count"))).alias("Count"),
        F.sum(F.when(head, F.col("Sum"))).alias("Sum"),
        F.min(F.when(head, F.col("Min"))).alias("Min"),
        F.max(F.when(head, F.col("Max"))).alias("Max"),
    )
    in_order = F.array_sort(
        F.collect_list(F.when(F.col("_pos").isNotNull(), F.struct("_pos", "_n")))
    )
    return (
        summed.groupBy(*keys)
        .agg(
            F.sum("Count").alias("Count"),
            F.sum("Sum").alias("Sum"),
            F.min("Min").alias("Min"),
            F.max("Max").alias("Max"),
            in_order.alias("_buckets"),
        )
        .select(
            *by,
            "Count",
            "Sum",
            F.col("_buckets._n").alias("BucketCounts"),
            "ExplicitBounds",
            "Min",
            "Max",
        )
    )


def quantile_of_buckets(counts: Column, bounds: Column, count: Column, q: float) -> Column:
    """Linear interpolation inside the bucket that holds rank `q * count`.

    The first bucket starts at 0, or at its own bound where that is not
    positive; the overflow bucket answers with the last bound; NULL when empty.
    """
    rank = F.lit(float(q)) * count.cast("double")
    last = F.size(counts) - 1
    start = F.struct(
        F.lit(0).alias("i"),
        F.lit(0.0).alias("below"),
        F.lit(None).cast("double").alias("value"),
    )

    def step(acc: Column, n: Column) -> Column:
        upper = F.get(bounds, acc["i"])
        lower = F.when(acc["i"] == 0, F.least(F.lit(0.0), upper)).otherwise(
            F.get(bounds, acc["i"] - 1)
        )
        inside = F.when(acc["i"] >= last, F.get(bounds, last - 1)).otherwise(
            lower + (upper - lower) * (rank - acc["below"]) / n.cast("double")
        )
        reached = acc["value"].isNull() & (n > 0) & (acc["below"] + n >= rank)
        return F.struct(
            (acc["i"] + 1).alias("i"),
            (acc["below"] + n).alias("below"),
            F.when(reached, inside).otherwise(acc["value"]).alias("value"),
        )

    found = F.aggregate(counts, start, step)["value"]
    return F.when((count > 0) & (F.size(bounds) > 0), found)


def histogram_quantile(points: DataFrame, q: float, name: str = "Quantile") -> DataFrame:
    """Add a quantile estimate to each histogram row; no shuffle."""
    return points.withColumn(
        name,
        quantile_of_buckets(F.col("BucketCounts"), F.col("ExplicitBounds"), F.col("Count"), q),
    )


def histogram_to_delta(
    points: DataFrame, slice_width: timedelta = DEFAULT_SLICE, first: str = "zero"
) -> DataFrame:
    """Cumulative histograms as per-interval ones.

    A reset (new start time, other bounds, or any falling count) makes the new
    arrays the interval's. The first point of a series counts as 0, or keeps
    its value with `first="value"`. Min and Max are unknown for an interval.
    """
    if first not in ("zero", "value"):
        raise ValueError("first must be 'zero' or 'value'")
    order = ["TimeUnixNanos", "StartTimeUnixNanos", "Count", "Sum"]
    carried = [*order, "BucketCounts", "ExplicitBounds"]
    cumulative = with_series_key(points).filter(
        F.col("AggregationTemporality") == TEMPORALITY_CUMULATIVE
    )
    df = previous_point(cumulative, SERIES, "TimeUnixNanos", order, carried, "_prev", slice_width)

    def grown(now: Column, before: Column) -> Column:
        return F.zip_with(now, before, lambda a, b: a - b)

    prev = F.col("_prev")
    growth = grown(F.col("BucketCounts"), prev["BucketCounts"])
    reset = (
        (F.col("StartTimeUnixNanos") != prev["StartTimeUnixNanos"])
        | (F.col("Count") < prev["Count"])
        | ~F.col("ExplicitBounds").eqNullSafe(prev["ExplicitBounds"])
        | (F.size("BucketCounts") != F.size(prev["BucketCounts"]))
        | F.coalesce(F.exists(growth, lambda d: d < 0), F.lit(False))
    )
    is_first = prev.isNull()

    def pick(now: Column, zero: Column, delta: Column) -> Column:
        return (
            F.when(is_first, now if first == "value" else zero).when(reset, now).otherwise(delta)
        )

    none = F.transform("BucketCounts", lambda _: _zero())
    changed = {
        "_buckets": pick(F.col("BucketCounts"), none, growth),
        "_count": pick(F.col("Count"), _zero(), F.col("Count") - prev["Count"]),
        "_sum": pick(F.col("Sum"), F.lit(0.0), F.col("Sum") - prev["Sum"]),
    }
    return (
        df.withColumns(changed)
        .withColumns(
            {
                "BucketCounts": F.col("_buckets"),
                "Count": F.col("_count"),
                "Sum": F.col("_sum"),
                "Min": F.lit(None).cast("double"),
                "Max": F.lit(None).cast("double"),
                "AggregationTemporality": F.lit(TEMPORALITY_DELTA),
            }
        )
        .drop("_prev", *changed)
    )


# ---------------------------------------------------------------- exponential


def exp_bound(index: Column, scale: Column) -> Column:
    """`base ** index` with `base = 2 ** (2 ** -scale)`."""
    step = F.pow(F.lit(2.0), -scale.cast("double"))
    return F.pow(F.lit(2.0), index.cast("double") * step)


def _indexed(counts: str, offset: str, kind: int) -> Column:
    """Non-empty buckets of one side as structs of kind, index and count."""
    all_buckets = F.transform(
        counts,
        lambda n, i: F.struct(
            F.lit(kind).alias("kind"),
            (F.col(offset).cast("bigint") + i).alias("idx"),
            n.alias("n"),
        ),
    )
    return F.filter(all_buckets, lambda b: b["n"] > 0)


# Bucket kinds in value order.
_NEGATIVE, _HEAD, _POSITIVE = -1, 0, 1


def exp_histogram_buckets(points: DataFrame, keep: list[str]) -> DataFrame:
    """Rows (lower, upper, count) of the non-empty buckets of each point.

    A positive bucket covers `(lower, upper]`, a negative one its mirror image;
    the zero bucket is (0, 0).
    """
    zero = F.filter(
        F.array(
            F.struct(
                F.lit(_HEAD).alias("kind"), _zero().alias("idx"), F.col("ZeroCount").alias("n")
            )
        ),
        lambda b: b["n"] > 0,
    )
    buckets = F.concat(
        _indexed("NegativeBucketCounts", "NegativeOffset", _NEGATIVE),
        zero,
        _indexed("PositiveBucketCounts", "PositiveOffset", _POSITIVE),
    )
    near = exp_bound(F.col("_b.idx"), F.col("Scale"))
    far = exp_bound(F.col("_b.idx") + 1, F.col("Scale"))
    kind = F.col("_b.kind")
    return points.select(*keep, "Scale", F.explode(buckets).alias("_b")).select(
        *keep,
        F.when(kind == _POSITIVE, near).when(kind == _NEGATIVE, -far).otherwise(0.0).alias("lower"),
        F.when(kind == _POSITIVE, far).when(kind == _NEGATIVE, -near).otherwise(0.0).alias("upper"),
        F.col("_b.n").alias("count"),
    )


def _dense(entries: Column) -> Column:
    """Counts of sorted (idx, n) entries with the gaps filled with zeros."""
    return F.flatten(
        F.transform(
            entries,
            lambda e, i: F.concat(
                F.array_repeat(
                    _zero(),
                    F.when(i == 0, F.lit(0))
                    .otherwise(e["idx"] - F.get(entries, i - 1)["idx"] - 1)
                    .cast("int"),
                ),
                F.array(e["n"]),
            ),
        )
    )


def merge_exp_buckets(points: DataFrame, by: list[str]) -> DataFrame:
    """Exponential histograms added up per group, as one row per non-empty bucket.

    Every point is brought to the smallest scale of its group: at a scale lower
    by d, bucket i is part of bucket `i >> d`. Buckets are counted per scale
    first, so the smallest scale is found on these counts and not by another
    pass over the points. `kind` is -1, 0 or 1 for negative buckets, the head
    row with the group's Count, Sum, ZeroCount, Min and Max, and positive ones.
    """
    head = F.array(
        F.struct(F.lit(_HEAD).alias("kind"), _zero().alias("idx"), _zero().alias("n"))
    )
    rows = points.select(
        *by,
        "Scale",
        "Count",
        "Sum",
        "ZeroCount",
        "Min",
        "Max",
        F.inline(
            F.concat(
                head,
                _indexed("NegativeBucketCounts", "NegativeOffset", _NEGATIVE),
                _indexed("PositiveBucketCounts", "PositiveOffset", _POSITIVE),
            )
        ),
    )
    totals = ["Count", "Sum", "ZeroCount"]

    def combine(df: DataFrame, *keys: str, at_head: bool) -> DataFrame:
        def value(c: str) -> Column:
            return F.when(F.col("kind") == _HEAD, F.col(c)) if at_head else F.col(c)

        return df.groupBy(*keys).agg(
            F.sum("n").alias("n"),
            *[F.sum(value(c)).alias(c) for c in totals],
            F.min(value("Min")).alias("Min"),
            F.max(value("Max")).alias("Max"),
        )

    per_scale = combine(rows, *by, "Scale", "kind", "idx", at_head=True)
    lowest = per_scale.withColumn("_low", F.min("Scale").over(Window.partitionBy(*by)))
    shifted = lowest.withColumns(
        {
            "idx": F.call_function("shiftright", F.col("idx"), F.col("Scale") - F.col("_low")),
            "Scale": F.col("_low"),
        }
    ).drop("_low")
    return combine(shifted, *by, "Scale", "kind", "idx", at_head=False)


def merge_exp_histograms(points: DataFrame, by: list[str]) -> DataFrame:
    """Merged exponential histograms with dense bucket arrays, one row per group.

    Cumulative points count once per run. Arrays run from the lowest to the
    highest non-empty bucket. For groups whose
    buckets lie extremely far apart use `merge_exp_buckets`, which has no arrays.
    """
    merged = merge_exp_buckets(last_of_runs(points), by)

    def side(kind: int) -> Column:
        return F.array_sort(
            F.collect_list(F.when(F.col("kind") == kind, F.struct("idx", "n")))
        )

    packed = merged.groupBy(*by, "Scale").agg(
        *[F.sum(c).alias(c) for c in ("Count", "Sum", "ZeroCount")],
        F.min("Min").alias("Min"),
        F.max("Max").alias("Max"),
        side(_POSITIVE).alias("_pos"),
        side(_NEGATIVE).alias("_neg"),
    )

    def offset(c: str) -> Column:
        return F.coalesce(F.get(F.col(c), F.lit(0))["idx"], _zero()).cast("int")

    return packed.select(
        *by,
        "Count",
        "Sum",
        "Scale",
        "ZeroCount",
        offset("_pos").alias("PositiveOffset"),
        _dense(F.col("_pos")).alias("PositiveBucketCounts"),
        offset("_neg").alias("NegativeOffset"),
        _dense(F.col("_neg")).alias("NegativeBucketCounts"),
        "Min",
        "Max",
    )


def exp_histogram_quantile(points: DataFrame, q: float, name: str = "Quantile") -> DataFrame:
    """Add a quantile estimate to each exponential histogram row; no shuffle.

    Buckets are walked in value order: negative ones from the highest index
    down, zero, positive ones. The answer is the geometric middle of the bucket
    that holds rank `q * Count`; NULL when Count is 0.
    """
    walk = F.concat(
        F.reverse(_indexed("NegativeBucketCounts", "NegativeOffset", _NEGATIVE)),
        F.filter(
            F.array(
                F.struct(
                    F.lit(_HEAD).alias("kind"), _zero().alias("idx"), F.col("ZeroCount").alias("n")
                )
            ),
            lambda b: b["n"] > 0,
        ),
        _indexed("PositiveBucketCounts", "PositiveOffset", _POSITIVE),
    )
    total = F.aggregate(walk, _zero(), lambda s, b: s + b["n"])
    rank = F.least(F.lit(float(q)) * F.col("Count").cast("double"), total.cast("double"))
    start = F.struct(
        F.lit(0.0).alias("below"),
        F.lit(None).cast("int").alias("kind"),
        F.lit(None).cast("bigint").alias("idx"),
    )

    def step(acc: Column, b: Column) -> Column:
        reached = acc["kind"].isNull() & (acc["below"] + b["n"] >= F.col("_rank"))
        return F.struct(
            (acc["below"] + b["n"]).alias("below"),
            F.when(reached, b["kind"]).otherwise(acc["kind"]).alias("kind"),
            F.when(reached, b["idx"]).otherwise(acc["idx"]).alias("idx"),
        )

    found = F.col("_found")
    middle = exp_bound(found["idx"] + F.lit(0.5), F.col("Scale"))
    return (
        points.withColumn("_rank", rank)
        .withColumn("_found", F.aggregate(walk, start, step))
        .withColumn(
            name,
            F.when(F.col("Count") > 0, found["kind"].cast("double") * middle),
        )
        .drop("_rank", "_found")
    )


def _shift(x: Column, by: Column) -> Column:
    return F.call_function("shiftright", x, by)


def _rescaled(counts: Column, offset: Column, by: Column) -> Column:
    """Dense counts at a scale lower by `by`: bucket i becomes part of bucket `i >> by`. One pass over them."""
    offset = offset.cast("bigint")
    first, last = _shift(offset, by), _shift(offset + F.size(counts) - 1, by)

    def inside(j: Column) -> Column:
        low = F.greatest(F.call_function("shiftleft", j, by) - offset, _zero())
        high = F.call_function("shiftleft", j + 1, by) - offset  # a slice may end beyond the array
        part = F.slice(counts, (low + 1).cast("int"), (high - low).cast("int"))
        return F.aggregate(part, _zero(), lambda n, x: n + x)

    merged = F.transform(F.sequence(first, F.greatest(first, last)), inside)
    return F.when((by <= 0) | (F.size(counts) == 0), counts).otherwise(merged)


def _total(counts: Column) -> Column:
    return F.aggregate(counts, _zero(), lambda n, x: n + x)


def exp_histogram_to_delta(
    points: DataFrame, slice_width: timedelta = DEFAULT_SLICE, first: str = "zero"
) -> DataFrame:
    """Cumulative exponential histograms as per-interval ones.

    Two points are compared at the smaller of their scales, and the interval has
    that scale. A reset (new start time, any falling count, or buckets that are
    gone) makes the new point the interval, at its own scale. The first point of
    a series counts as 0, or keeps its value with `first="value"`. Bucket arrays
    keep the range of the new point. Min and Max are unknown for an interval.
    """
    if first not in ("zero", "value"):
        raise ValueError("first must be 'zero' or 'value'")
    order = ["TimeUnixNanos", "StartTimeUnixNanos", "Count", "Sum"]
    sides = ("Positive", "Negative")
    arrays = [c for s in sides for c in (f"{s}Offset", f"{s}BucketCounts")]
    carried = [*order, "Scale", "ZeroCount", *arrays]
    cumulative = with_series_key(points).filter(
        F.col("AggregationTemporality") == TEMPORALITY_CUMULATIVE
    )
    df = previous_point(cumulative, SERIES, "TimeUnixNanos", order, carried, "_prev", slice_width)
    prev = F.col("_prev")
    df = df.withColumn("_low", F.least("Scale", prev["Scale"]))
    now_by, prev_by = F.col("Scale") - F.col("_low"), prev["Scale"] - F.col("_low")
    for s in sides:
        counts, offset = f"{s}BucketCounts", f"{s}Offset"
        df = df.withColumns(
            {
                f"_now{s}": _rescaled(F.col(counts), F.col(offset), now_by),
                f"_at{s}": _shift(F.col(offset).cast("bigint"), now_by),
                f"_old{s}": _rescaled(prev[counts], prev[offset], prev_by),
                f"_oldat{s}": _shift(prev[offset].cast("bigint"), prev_by),
            }
        )

    def matched(side: str) -> Column:
        """What the old array takes off each bucket of the new one."""
        old, ahead = F.col(f"_old{side}"), F.col(f"_at{side}") - F.col(f"_oldat{side}")
        return F.transform(f"_now{side}", lambda _, i: F.coalesce(F.get(old, (ahead + i).cast("int")), _zero()))

    gone = F.lit(False)
    for s in sides:
        df = df.withColumn(f"_off{s}", matched(s))
        df = df.withColumn(f"_grown{s}", F.zip_with(f"_now{s}", f"_off{s}", lambda a, b: a - b))
        falls = F.exists(f"_grown{s}", lambda d: d < 0)
        gone = gone | falls | (_total(F.col(f"_off{s}")) != _total(F.col(f"_old{s}")))
    reset = (
        (F.col("StartTimeUnixNanos") != prev["StartTimeUnixNanos"])
        | (F.col("Count") < prev["Count"])
        | (F.col("ZeroCount") < prev["ZeroCount"])
        | F.coalesce(gone, F.lit(False))
    )
    df = df.withColumn("_reset", reset)
    is_first = prev.isNull()

    def pick(now: Column, zero: Column, delta: Column) -> Column:
        return (
            F.when(is_first, now if first == "value" else zero)
            .when(F.col("_reset"), now)
            .otherwise(delta)
        )

    def none(counts: str) -> Column:
        return F.transform(counts, lambda _: _zero())

    changed = {
        "Count": pick(F.col("Count"), _zero(), F.col("Count") - prev["Count"]),
        "Sum": pick(F.col("Sum"), F.lit(0.0), F.col("Sum") - prev["Sum"]),
        "ZeroCount": pick(F.col("ZeroCount"), _zero(), F.col("ZeroCount") - prev["ZeroCount"]),
        "Scale": pick(F.col("Scale"), F.col("Scale"), F.col("_low")),
    }
    for s in sides:
        counts, offset = f"{s}BucketCounts", f"{s}Offset"
        changed[counts] = pick(F.col(counts), none(counts), F.col(f"_grown{s}"))
        changed[offset] = pick(F.col(offset), F.col(offset), F.col(f"_at{s}").cast("int"))
    helpers = [c for c in df.columns if c.startswith("_")]
    out = df.withColumns(
        {
            **changed,
            "Min": F.lit(None).cast("double"),
            "Max": F.lit(None).cast("double"),
            "AggregationTemporality": F.lit(TEMPORALITY_DELTA),
        }
    )
    return out.drop(*helpers)
