"""Number metrics: series filters, trends, counters, exemplars, summaries."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from signalbarn.functions.columns import (
    NANOS_PER_SECOND,
    attr_equals,
    div,
    in_day_range,
    in_time_range,
    nanos_to_timestamp,
    series_key,
)
from signalbarn.functions.series import DEFAULT_SLICE, previous_point, running_total
from signalbarn.operators.keys import with_ids
from signalbarn.schemas import TEMPORALITY_CUMULATIVE, TEMPORALITY_DELTA

SERIES = ["ServiceName", "MetricName", "SeriesKey"]
_ORDER = ["TimeUnixNanos", "StartTimeUnixNanos", "Value"]


def with_series_key(points: DataFrame) -> DataFrame:
    """Stored tables carry `SeriesKey`; other inputs get it here. NULL attributes are no attributes."""
    none = F.lit("{}")
    own = "SeriesKey" if "SeriesKey" in points.columns else series_key("Attributes")
    return points.withColumn("SeriesKey", F.coalesce(own, none))


def with_value(points: DataFrame) -> DataFrame:
    """Points that recorded a value; the others only tell that there was none."""
    return points.filter(F.col("Value").isNotNull())


def last_of_runs(points: DataFrame) -> DataFrame:
    """Points that can be added up: of each cumulative run only the last point, all others as they are.

    A run is a series with one start time. Its points repeat what came before,
    so only the last one counts. Filters on the temporality reach the scan, and
    a run sends one row per task.
    """
    if "AggregationTemporality" not in points.columns:
        return points
    is_cumulative = F.coalesce(
        F.col("AggregationTemporality") == TEMPORALITY_CUMULATIVE, F.lit(False)
    )
    newest = Window.partitionBy(*SERIES, "StartTimeUnixNanos").orderBy(
        F.desc("TimeUnixNanos"), F.desc("Count"), F.desc("Sum")
    )
    last = (
        with_series_key(points.filter(is_cumulative))
        .withColumn("_rank", F.row_number().over(newest))
        .filter(F.col("_rank") == 1)
    )
    return points.filter(~is_cumulative).unionByName(last.select(*points.columns))


def series_for(
    points: DataFrame,
    service: str,
    metric: str,
    dims: dict[str, str] | None = None,
    start: int | datetime | None = None,
    end: int | datetime | None = None,
) -> DataFrame:
    """Points of one metric of one service, by attribute values and time range."""
    cond = (
        (F.col("ServiceName") == service)
        & (F.col("MetricName") == metric)
        & in_time_range("TimeUnixNanos", start, end)
    )
    for key, value in (dims or {}).items():
        cond = cond & attr_equals("Attributes", key, value)
    if "EventDate" in points.columns:
        cond = cond & in_day_range("EventDate", start, end)
    return points.filter(cond)


# ---------------------------------------------------------------- nested columns


def explode_exemplars(points: DataFrame) -> DataFrame:
    """One row per exemplar of a gauge, sum or histogram point."""
    return points.select(
        "ServiceName", "MetricName", "TimeUnixNanos", F.explode("Exemplars").alias("x")
    ).select(
        "ServiceName",
        "MetricName",
        "TimeUnixNanos",
        F.col("x.FilteredAttributes").alias("ExemplarAttributes"),
        F.col("x.TimeUnixNanos").alias("ExemplarTimeNanos"),
        F.col("x.Value").alias("ExemplarValue"),
        F.col("x.TraceId").alias("TraceId"),
        F.col("x.SpanId").alias("SpanId"),
    )


def exemplars_to_spans(points: DataFrame, spans: DataFrame) -> DataFrame:
    """Metric points joined with the spans that produced them."""
    targets = spans.filter(with_ids()).select(
        "TraceId",
        "SpanId",
        F.col("ServiceName").alias("SpanService"),
        "SpanName",
        "Duration",
        "StatusCode",
    )
    return explode_exemplars(points).filter(with_ids()).join(targets, ["TraceId", "SpanId"])


def explode_quantiles(summaries: DataFrame) -> DataFrame:
    """One row per quantile of a summary point."""
    return summaries.select(
        "ServiceName",
        "MetricName",
        "TimeUnixNanos",
        "Count",
        "Sum",
        F.explode("ValueAtQuantiles").alias("q"),
    ).select(
        "ServiceName",
        "MetricName",
        "TimeUnixNanos",
        "Count",
        "Sum",
        F.col("q.Quantile").alias("Quantile"),
        F.col("q.Value").alias("QuantileValue"),
    )


def summary_at(summaries: DataFrame, quantile: float, sla: float | None = None) -> DataFrame:
    """`AtQuantile`: each point's value at one quantile; `MeetsSla` when a limit is given.

    Row by row only: summaries of several instances cannot be merged, since
    quantiles do not add. There is deliberately no grouping parameter.
    """
    at = F.filter("ValueAtQuantiles", lambda q: q["Quantile"] == F.lit(quantile))
    out = summaries.withColumn("AtQuantile", F.try_element_at(at, F.lit(1))["Value"])
    if sla is None:
        return out
    return out.withColumn("MeetsSla", F.col("AtQuantile") <= F.lit(sla))


# ---------------------------------------------------------------- aggregates


def mean_from_sum_count(points: DataFrame, by: list[str]) -> DataFrame:
    """Mean of the recorded values: summed Sum over summed Count, NULL without any.

    Cumulative points count once per run.
    """
    return last_of_runs(points).groupBy(*by).agg(
        (F.sum("Sum") / F.nullif(F.sum("Count"), F.lit(0).cast("bigint"))).alias("mean")
    )


def series_cardinality(points: DataFrame, approximate: bool = False) -> DataFrame:
    """Number of distinct series per service and metric."""
    points = with_series_key(points)
    if approximate:
        count = F.approx_count_distinct("SeriesKey")
    else:
        count = F.count_distinct("SeriesKey")
    return points.groupBy("ServiceName", "MetricName").agg(count.alias("series"))


#: Accuracy of stored sketches: 2 ** SKETCH_BITS registers, a standard error of about 0.8 %.
SKETCH_BITS = 14


def series_sketches(points: DataFrame, bits: int = SKETCH_BITS) -> DataFrame:
    """Per day, service and metric a sketch of the distinct series: some 12 kB, whatever their number.

    Sketches are stored once a day is closed and merged over any days and
    services by `series_of_sketches`, without going back to the points.
    """
    day = "EventDate" if "EventDate" in points.columns else F.to_date("TimeUnix").alias("EventDate")
    return (
        with_series_key(points)
        .groupBy(day, "ServiceName", "MetricName")
        .agg(F.hll_sketch_agg("SeriesKey", F.lit(bits)).alias("Sketch"))
    )


def series_of_sketches(sketches: DataFrame, by: list[str]) -> DataFrame:
    """About how many distinct series the sketches of each group have seen together."""
    merged = sketches.groupBy(*by).agg(F.hll_union_agg("Sketch").alias("_sketch"))
    return merged.select(*by, F.hll_sketch_estimate("_sketch").alias("series"))


def metric_trend(points: DataFrame, width: timedelta) -> DataFrame:
    """Per series and time bucket: count, sum, min, max, avg and the last value.

    Points without a value are left out.
    """
    step = (width // timedelta(microseconds=1)) * 1000
    bucket = (div("TimeUnixNanos", step) * step).alias("BucketNanos")
    return (
        with_series_key(with_value(points))
        .groupBy(*SERIES, bucket)
        .agg(
            F.count("Value").alias("count"),
            F.sum("Value").alias("sum"),
            F.min("Value").alias("min"),
            F.max("Value").alias("max"),
            F.avg("Value").alias("avg"),
            F.max(F.struct("TimeUnixNanos", "Value")).alias("_last"),
        )
        .select(
            *SERIES,
            nanos_to_timestamp("BucketNanos").alias("Bucket"),
            "BucketNanos",
            "count",
            "sum",
            "min",
            "max",
            "avg",
            F.col("_last.Value").alias("last"),
        )
    )


def latest_per_series(points: DataFrame) -> DataFrame:
    """Newest point of each series that has a value.

    Spark cuts `row_number() = 1` on the map side (window group limit), so a
    busy series sends one row per task.
    """
    newest = Window.partitionBy(*SERIES).orderBy(
        F.desc("TimeUnixNanos"), F.desc("StartTimeUnixNanos"), F.desc("Value")
    )
    if "Value" in points.columns:
        points = with_value(points)
    return (
        with_series_key(points)
        .withColumn("_rank", F.row_number().over(newest))
        .filter(F.col("_rank") == 1)
        .drop("_rank")
    )


# ---------------------------------------------------------------- counters


def _increase(first: Column) -> Column:
    """Growth since the point before; after a reset the new value is the growth."""
    reset = (F.col("StartTimeUnixNanos") != F.col("_prev.StartTimeUnixNanos")) | (
        F.col("Value") < F.col("_prev.Value")
    )
    return (
        F.when(F.col("_prev").isNull(), first)
        .when(reset, F.col("Value"))
        .otherwise(F.col("Value") - F.col("_prev.Value"))
    )


def _with_previous(points: DataFrame, slice_width: timedelta) -> DataFrame:
    return previous_point(
        with_series_key(points), SERIES, "TimeUnixNanos", _ORDER, _ORDER, "_prev", slice_width
    )


def _cumulative(points: DataFrame) -> DataFrame:
    return with_value(points).filter(F.col("AggregationTemporality") == TEMPORALITY_CUMULATIVE)


def counter_increase(points: DataFrame, slice_width: timedelta = DEFAULT_SLICE) -> DataFrame:
    """`Increase` of each point of cumulative monotonic sums, with reset detection.

    The first point of a series contributes 0. Other points are left out.
    """
    counters = _cumulative(points).filter(F.col("IsMonotonic"))
    return (
        _with_previous(counters, slice_width)
        .withColumn("Increase", _increase(F.lit(0.0)))
        .drop("_prev")
    )


def counter_rate(points: DataFrame, slice_width: timedelta = DEFAULT_SLICE) -> DataFrame:
    """`Increase` and `Rate` per second since the point before; NULL for the first."""
    counters = _cumulative(points).filter(F.col("IsMonotonic"))
    seconds = (F.col("TimeUnixNanos") - F.col("_prev.TimeUnixNanos")) / NANOS_PER_SECOND
    return (
        _with_previous(counters, slice_width)
        .withColumn("Increase", _increase(F.lit(0.0)))
        .withColumn("Rate", F.try_divide(F.col("Increase"), seconds))
        .drop("_prev")
    )


def cumulative_to_delta(points: DataFrame, slice_width: timedelta = DEFAULT_SLICE) -> DataFrame:
    """Cumulative points as delta points; the first keeps its value.

    Each delta starts where the point before ended; after a reset it starts at
    the point's own start time.
    """
    reset = (F.col("StartTimeUnixNanos") != F.col("_prev.StartTimeUnixNanos")) | (
        F.col("Value") < F.col("_prev.Value")
    )
    start = F.when(F.col("_prev").isNull() | reset, F.col("StartTimeUnixNanos")).otherwise(
        F.col("_prev.TimeUnixNanos")
    )
    with_prev = _with_previous(_cumulative(points), slice_width)
    plain = F.when(F.col("IsMonotonic"), _increase(F.col("Value"))).otherwise(
        _signed_change(F.col("Value"))
    )
    return (
        with_prev.withColumns({"_value": plain, "_start": start})
        .withColumns(
            {
                "Value": F.col("_value"),
                "StartTimeUnixNanos": F.col("_start"),
                "StartTimeUnix": nanos_to_timestamp("_start"),
                "AggregationTemporality": F.lit(TEMPORALITY_DELTA),
            }
        )
        .drop("_prev", "_value", "_start")
    )


def delta_to_cumulative(points: DataFrame, slice_width: timedelta = DEFAULT_SLICE) -> DataFrame:
    """Delta points as running totals since the start of their series."""
    deltas = with_series_key(with_value(points)).filter(
        F.col("AggregationTemporality") == TEMPORALITY_DELTA
    )
    return (
        running_total(
            deltas,
            SERIES,
            "TimeUnixNanos",
            _ORDER,
            "Value",
            "_total",
            first={"_start": F.col("StartTimeUnixNanos")},
            slice_width=slice_width,
        )
        .withColumns(
            {
                "Value": F.col("_total"),
                "StartTimeUnixNanos": F.col("_start"),
                "StartTimeUnix": nanos_to_timestamp("_start"),
                "AggregationTemporality": F.lit(TEMPORALITY_CUMULATIVE),
            }
        )
        .drop("_total", "_start")
    )


def sum_total(
    points: DataFrame, by: list[str], slice_width: timedelta = DEFAULT_SLICE
) -> DataFrame:
    """`total` growth per group, and how many points `unspecified` temporality leaves out.

    Delta points add up. Cumulative points first become increases, since adding
    running totals would count the same growth again and again; without
    monotonicity a fall counts as a fall. The first point of a series adds 0.
    Points that say neither cannot be added to anything; they are counted.
    """
    temporality = F.coalesce(F.col("AggregationTemporality"), F.lit(0))
    is_delta = temporality == TEMPORALITY_DELTA
    none = F.lit(0).cast("bigint")
    left = F.when(~is_delta, F.lit(1).cast("bigint")).otherwise(none)
    plain = points.filter(temporality != TEMPORALITY_CUMULATIVE).select(
        *by, F.when(is_delta, F.col("Value")).alias("Increase"), left.alias("_left")
    )
    # counters and sums that may fall go through the same slices; the flag says how a point changes
    monotonic = F.coalesce("IsMonotonic", F.lit(False))
    change = F.when(monotonic, _increase(F.lit(0.0))).otherwise(_signed_change(F.lit(0.0)))
    changes = _with_previous(_cumulative(points), slice_width).select(
        *by, change.alias("Increase"), none.alias("_left")
    )
    return plain.unionByName(changes).groupBy(*by).agg(
        F.sum("Increase").alias("total"), F.sum("_left").alias("unspecified")
    )


def _signed_change(first: Column) -> Column:
    """Change since the point before where a fall is a fall; after a new start the value itself."""
    restarted = F.col("StartTimeUnixNanos") != F.col("_prev.StartTimeUnixNanos")
    return (
        F.when(F.col("_prev").isNull(), first)
        .when(restarted, F.col("Value"))
        .otherwise(F.col("Value") - F.col("_prev.Value"))
    )
