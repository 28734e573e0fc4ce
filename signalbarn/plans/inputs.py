"""Telemetry-shaped inputs derived from the `events` and `documents` tables.

One row per event unless grouped. Only integer arithmetic, so that the SQL
counterparts in `oracle.py` give equal rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from signalbarn.functions.columns import sql_series_key, sql_timestamp
from signalbarn.functions.quantiles import exact_quantiles
from signalbarn.operators.metrics import delta_to_cumulative
from signalbarn.schemas import (
    EVENTS,
    EXEMPLARS,
    LINKS,
    TEMPORALITY_CUMULATIVE,
    TEMPORALITY_DELTA,
)

# Histogram bounds in cents.
BOUNDS = [100, 500, 1000, 2500, 5000, 10000, 25000]

_NO_ATTRS = "CAST(map() AS MAP<STRING,STRING>)"
_NO_EXEMPLARS = f"CAST(array() AS {EXEMPLARS})"


def _trace_id(event: str) -> str:
    return f"md5(concat('t', CAST(({event}) div 5 AS STRING)))"


def _span_id(event: str) -> str:
    return f"substring(md5(concat('s', CAST({event} AS STRING))), 1, 16)"


def _project(df: DataFrame, columns: dict[str, str], *extra: str) -> DataFrame:
    return df.selectExpr(*[f"{sql} AS {name}" for name, sql in columns.items()], *extra)


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _project(
        spark.read.parquet(f"{sf_dir}/events.parquet"),
        {
            "event_id": "event_id",
            "user_id": "user_id",
            "event_type": "event_type",
            "cents": "CAST(round(value * 100) AS BIGINT)",
            "svc": "concat('svc-', CAST(user_id % 8 AS STRING))",
            "d": "CAST(ts AS DATE)",
            "k": "get_json_object(props, '$.k')",
            "nanos": "unix_micros(CAST(ts AS TIMESTAMP)) * 1000 + event_id % 1000",
        },
    )


# ---------------------------------------------------------------- spans and logs

_SPAN = {
    "Timestamp": sql_timestamp("nanos"),
    "TimestampNanos": "nanos",
    "TraceId": _trace_id("event_id"),
    "SpanId": _span_id("event_id"),
    "ParentSpanId": (
        "CASE WHEN event_id % 5 = 0 THEN '' ELSE "
        + _span_id("event_id - event_id % 5 + (event_id % 5 - 1) div 2")
        + " END"
    ),
    "TraceState": "''",
    "SpanName": "event_type",
    "SpanKind": (
        "CASE event_type WHEN 'view' THEN 'Server' WHEN 'click' THEN 'Client' "
        "ELSE 'Internal' END"
    ),
    "ServiceName": "svc",
    "ResourceAttributes": "map('service.name', svc)",
    "ScopeName": "''",
    "ScopeVersion": "''",
    "SpanAttributes": "map('k', k)",
    "Duration": "cents * 10000",
    "StatusCode": (
        "CASE event_type WHEN 'error' THEN 'Error' WHEN 'purchase' THEN 'Ok' ELSE 'Unset' END"
    ),
    "StatusMessage": "''",
    "Events": (
        "CASE WHEN event_type = 'error' THEN array(named_struct("
        f"'Timestamp', {sql_timestamp('nanos')}, 'TimestampNanos', nanos, 'Name', 'exception', "
        f"'Attributes', map('exception.type', concat('E', k)))) ELSE CAST(array() AS {EVENTS}) END"
    ),
    "Links": (
        "CASE WHEN event_id % 7 = 0 AND event_id >= 5 THEN array(named_struct("
        f"'TraceId', {_trace_id('event_id - 5')}, 'SpanId', {_span_id('event_id - 5')}, "
        f"'TraceState', '', 'Attributes', {_NO_ATTRS})) ELSE CAST(array() AS {LINKS}) END"
    ),
    "EventDate": "d",
}

_LOG = {
    "Timestamp": sql_timestamp("nanos"),
    "TimestampNanos": "nanos",
    "ObservedTimestampNanos": "nanos + (user_id % 5) * 1000000000",
    "ObservedTimestamp": sql_timestamp("nanos + (user_id % 5) * 1000000000"),
    "TraceId": f"CASE WHEN event_id % 10 = 0 THEN '' ELSE {_trace_id('event_id')} END",
    "SpanId": f"CASE WHEN event_id % 10 = 0 THEN '' ELSE {_span_id('event_id')} END",
    "TraceFlags": "0L",
    "SeverityText": (
        "CASE event_type WHEN 'error' THEN 'ERROR' WHEN 'view' THEN 'WARN' "
        "WHEN 'click' THEN 'DEBUG' ELSE 'INFO' END"
    ),
    "SeverityNumber": (
        "CASE event_type WHEN 'error' THEN 17 WHEN 'view' THEN 13 WHEN 'click' THEN 5 ELSE 9 END"
    ),
    "ServiceName": "svc",
    "ServiceVersion": "concat('1.', CAST(user_id % 3 AS STRING))",
    "Body": (
        "concat('event_', event_type, ' user=', CAST(user_id AS STRING), ' cents=', "
        "CAST(cents AS STRING), ' k=', k)"
    ),
    "ResourceAttributes": (
        "map('service.name', svc, 'service.version', concat('1.', CAST(user_id % 3 AS STRING)))"
    ),
    "ResourceSchemaUrl": "''",
    "ScopeName": "''",
    "ScopeVersion": "''",
    "ScopeAttributes": _NO_ATTRS,
    "ScopeDroppedAttrCount": "0L",
    "ScopeSchemaUrl": "''",
    "LogAttributes": "map('event_type', event_type, 'k', k)",
    "LogDroppedAttrCount": "0L",
    "EventDate": "d",
}


def spans_of(events: DataFrame, *extra: str) -> DataFrame:
    """One span per event; `extra` names further event columns to keep."""
    return _project(events, _SPAN, *extra)


def logs_of(events: DataFrame, *extra: str) -> DataFrame:
    """One log record per event; `extra` names further event columns to keep."""
    return _project(events, _LOG, *extra)


def spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spans_of(events(spark, sf_dir))


def logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return logs_of(events(spark, sf_dir))


def log_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prose bodies for token search: one row per document, the whole text."""
    return _project(
        spark.read.parquet(f"{sf_dir}/documents.parquet"),
        {
            "doc_id": "doc_id",
            "Body": "text",
            "ServiceName": "source",
            "TimestampNanos": (
                "(unix_seconds(TIMESTAMP'2024-01-01 00:00:00') + doc_id * 60) * 1000000000"
            ),
        },
    )


# ---------------------------------------------------------------- metrics

_MIDNIGHT = "unix_micros(CAST(d AS TIMESTAMP)) * 1000"
_DAY_END = f"{_MIDNIGHT} + 86400L * 1000000000L - 1"


def _metric(metric: str, attributes: str, start: str, time: str) -> dict[str, str]:
    return {
        "ResourceAttributes": "map('service.name', svc)",
        "ResourceSchemaUrl": "''",
        "ScopeName": "''",
        "ScopeVersion": "''",
        "ScopeAttributes": _NO_ATTRS,
        "ScopeDroppedAttrCount": "0L",
        "ScopeSchemaUrl": "''",
        "ServiceName": "svc",
        "MetricName": f"'{metric}'",
        "MetricDescription": "''",
        "MetricUnit": "'cents'",
        "Attributes": attributes,
        "SeriesKey": sql_series_key(attributes),
        "StartTimeUnix": sql_timestamp(start),
        "StartTimeUnixNanos": start,
        "TimeUnix": sql_timestamp(time),
        "TimeUnixNanos": time,
        "Flags": "0L",
        "EventDate": "d",
    }


_BY_TYPE = "map('event_type', event_type)"
_BY_SERVICE = "map('service.name', svc)"


def gauge(spark: SparkSession, sf_dir: str) -> DataFrame:
    exemplar = (
        f"named_struct('FilteredAttributes', map('k', k), 'TimeUnix', {sql_timestamp('nanos')}, "
        "'TimeUnixNanos', nanos, 'Value', CAST(cents AS DOUBLE), "
        f"'SpanId', {_span_id('event_id')}, 'TraceId', {_trace_id('event_id')})"
    )
    return _project(
        events(spark, sf_dir),
        {
            **_metric("event.value", _BY_TYPE, "nanos", "nanos"),
            "Value": "CAST(cents AS DOUBLE)",
            "Exemplars": f"array({exemplar})",
            "AggregationTemporality": "0",
            "IsMonotonic": "false",
        },
    )


def sum_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _project(
        events(spark, sf_dir),
        {
            **_metric("event.cents", _BY_SERVICE, _MIDNIGHT, "nanos"),
            "Value": "CAST(cents AS DOUBLE)",
            "Exemplars": _NO_EXEMPLARS,
            "AggregationTemporality": str(TEMPORALITY_DELTA),
            "IsMonotonic": "true",
        },
    )


def sum_cumulative(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running total per service that starts anew every midnight."""
    daily = sum_delta(spark, sf_dir).withColumns(
        {"_key": F.col("SeriesKey"), "SeriesKey": F.col("EventDate").cast("string")}
    )
    return (
        delta_to_cumulative(daily)
        .withColumn("SeriesKey", F.col("_key"))
        .drop("_key")
        .withColumn("AggregationTemporality", F.lit(TEMPORALITY_CUMULATIVE))
    )


def sum_with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The running totals with some points that recorded no value."""
    gap = F.col("TimeUnixNanos") % 7 == 0
    return sum_cumulative(spark, sf_dir).withColumns(
        {"Value": F.when(~gap, F.col("Value")), "Flags": F.when(gap, 1).otherwise(0).cast("bigint")}
    )


def sum_up_and_down(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sums that may fall, and some points that do not tell their temporality."""
    unknown = F.col("TimeUnixNanos") % 11 == 0
    return sum_cumulative(spark, sf_dir).withColumns(
        {
            "Value": F.col("Value") % 1000,
            "IsMonotonic": F.lit(False),
            "AggregationTemporality": F.when(unknown, 0).otherwise(F.col("AggregationTemporality")),
        }
    )


def _bucket_counts() -> str:
    edges = [None, *BOUNDS, None]
    counts = []
    for low, high in zip(edges, edges[1:]):
        tests = []
        if low is not None:
            tests.append(f"cents > {low}")
        if high is not None:
            tests.append(f"cents <= {high}")
        counts.append(f"count_if({' AND '.join(tests)})")
    return f"array({', '.join(counts)})"


def histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    grouped = (
        events(spark, sf_dir)
        .groupBy("svc", "event_type", "d")
        .agg(
            F.expr("count(1) AS n"),
            F.expr("sum(cents) AS total"),
            F.expr("min(cents) AS low"),
            F.expr("max(cents) AS high"),
            F.expr(f"{_bucket_counts()} AS buckets"),
        )
    )
    return _project(
        grouped,
        {
            **_metric("event.cents.hist", _BY_TYPE, _MIDNIGHT, _DAY_END),
            "Count": "n",
            "Sum": "CAST(total AS DOUBLE)",
            "BucketCounts": "buckets",
            "ExplicitBounds": f"array({', '.join(f'{b}D' for b in BOUNDS)})",
            "Exemplars": _NO_EXEMPLARS,
            "Min": "CAST(low AS DOUBLE)",
            "Max": "CAST(high AS DOUBLE)",
            "AggregationTemporality": str(TEMPORALITY_DELTA),
        },
    )


def histogram_cumulative(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily histograms added up over the days of each series."""
    daily = histogram(spark, sf_dir)
    series = ["ServiceName", "MetricName", "SeriesKey"]
    # One row per series and calendar day, so a group is never large.
    upto = (
        Window.partitionBy(*series)
        .orderBy("EventDate")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    running = [F.sum(F.get("BucketCounts", F.lit(i))).over(upto) for i in range(len(BOUNDS) + 1)]
    return daily.withColumns(
        {
            "BucketCounts": F.array(*running),
            "Count": F.sum("Count").over(upto),
            "Sum": F.sum("Sum").over(upto),
            "Min": F.min("Min").over(upto),
            "Max": F.max("Max").over(upto),
            "StartTimeUnixNanos": F.min("StartTimeUnixNanos").over(upto),
            "StartTimeUnix": F.min("StartTimeUnix").over(upto),
            "AggregationTemporality": F.lit(TEMPORALITY_CUMULATIVE),
        }
    )


def exp_histogram(spark: SparkSession, sf_dir: str, mixed_scales: bool = False) -> DataFrame:
    """Scale 0; the index of a value v is `bit length of (v - 1)` minus one.

    With `mixed_scales`, odd days have scale -1, where index i stands for the
    indexes 2i and 2i + 1 of scale 0. Counts are taken per bucket first, so a
    group is at most some 60 rows.
    """
    coarser = "dayofmonth(d) % 2" if mixed_scales else "0"
    index = f"shiftright(CASE WHEN cents <= 1 THEN -1 ELSE length(bin(cents - 1)) - 1 END, {coarser})"
    buckets = (
        events(spark, sf_dir)
        .groupBy("svc", "d", F.expr(f"{index} AS idx"))
        .agg(
            F.expr("count(1) AS n"),
            F.expr("sum(cents) AS total"),
            F.expr("min(cents) AS low"),
            F.expr("max(cents) AS high"),
        )
    )
    grouped = buckets.groupBy("svc", "d").agg(
        F.expr("sum(n) AS n"),
        F.expr("sum(total) AS total"),
        F.expr("min(low) AS low"),
        F.expr("max(high) AS high"),
        F.expr("min(idx) AS first"),
        F.expr("max(idx) AS last"),
        F.expr("map_from_entries(collect_list(struct(idx, n))) AS counts"),
    )
    return _project(
        grouped,
        {
            **_metric("event.cents.exp", _BY_SERVICE, _MIDNIGHT, _DAY_END),
            "Count": "n",
            "Sum": "CAST(total AS DOUBLE)",
            "Scale": f"-({coarser})",
            "ZeroCount": "0L",
            "PositiveOffset": "first",
            "PositiveBucketCounts": (
                "transform(sequence(first, last), i -> coalesce(try_element_at(counts, i), 0L))"
            ),
            "NegativeOffset": "0",
            "NegativeBucketCounts": "CAST(array() AS ARRAY<BIGINT>)",
            "Exemplars": _NO_EXEMPLARS,
            "Min": "CAST(low AS DOUBLE)",
            "Max": "CAST(high AS DOUBLE)",
            "AggregationTemporality": str(TEMPORALITY_DELTA),
        },
    )


def summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    grouped = exact_quantiles(
        events(spark, sf_dir),
        ["svc", "d"],
        "cents",
        {"q50": "0.5", "q90": "0.9", "q99": "0.99"},
        {
            "n": (F.count(F.lit(1)), F.sum("n")),
            "total": (F.sum("cents"), F.sum("total")),
        },
    )
    pairs = ", ".join(
        f"named_struct('Quantile', {q}D, 'Value', CAST({c} AS DOUBLE))"
        for q, c in ((0.5, "q50"), (0.9, "q90"), (0.99, "q99"))
    )
    return _project(
        grouped,
        {
            **_metric("event.cents.summary", _BY_SERVICE, _MIDNIGHT, _DAY_END),
            "Count": "n",
            "Sum": "CAST(total AS DOUBLE)",
            "ValueAtQuantiles": f"array({pairs})",
        },
    )


def exp_histogram_cumulative(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily histograms as runs of two cumulative points: half of the counts, then all."""
    whole = exp_histogram(spark, sf_dir, mixed_scales=True).withColumn(
        "AggregationTemporality", F.lit(TEMPORALITY_CUMULATIVE)
    )
    half = whole.withColumns(
        {
            "TimeUnixNanos": F.col("TimeUnixNanos") - 3_600_000_000_000,
            "Count": F.floor(F.col("Count") / 2),
            "Sum": F.col("Sum") / 2,
            "PositiveBucketCounts": F.transform("PositiveBucketCounts", lambda n: F.floor(n / 2)),
        }
    )
    return whole.unionByName(half)


def user_gauge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gauge points with a series for each user and key, many more than services."""
    series = "map('k', k, 'user', CAST(user_id AS STRING))"
    return _project(
        events(spark, sf_dir),
        {**_metric("event.by_user", series, "nanos", "nanos"), "Value": "CAST(cents AS DOUBLE)"},
    )


# Exponential histograms of signed values: positions -1 to 29 of each side.
_FIRST, _LAST = -1, 29


def exp_histogram_signed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running histograms per service over the days, cumulative since the first day.

    Every third event counts as a negative value and every tenth cent as zero.
    The scale is 0 up to the 14th of a month and -1 from then on, where bucket i
    stands for the buckets 2i and 2i + 1 of scale 0.
    """
    index = "CASE WHEN cents <= 1 THEN -1 ELSE length(bin(cents - 1)) - 1 END"
    positions = range(_FIRST, _LAST + 1)
    daily = (
        events(spark, sf_dir)
        .withColumn("idx", F.expr(index))
        .withColumn("zero", F.expr("cents % 10 = 0"))
        .withColumn("negative", F.expr("event_id % 3 = 0"))
        .groupBy("svc", "d")
        .agg(
            F.expr("count(1) AS n"),
            F.expr("sum(CASE WHEN zero THEN 0 WHEN negative THEN -cents ELSE cents END) AS total"),
            F.expr("count_if(zero) AS zeros"),
            *[
                F.array(*[F.count_if(F.expr(f"NOT zero AND {side} AND idx = {i}")) for i in positions]).alias(name)
                for name, side in (("pos", "NOT negative"), ("neg", "negative"))
            ],
        )
    )
    # one row per service and calendar day, so a group is never large
    upto = Window.partitionBy("svc").orderBy("d").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = daily.select(
        "svc",
        "d",
        F.sum("n").over(upto).alias("n"),
        F.sum("total").over(upto).alias("total"),
        F.sum("zeros").over(upto).alias("zeros"),
        *[
            F.array(*[F.sum(F.get(c, F.lit(i))).over(upto) for i in range(len(positions))]).alias(c)
            for c in ("pos", "neg")
        ],
        F.min("d").over(upto).alias("first_day"),
    )
    coarse = "dayofmonth(d) >= 15"

    def buckets(c: str) -> str:
        # position -1 of scale 0 is the upper half of position -1 of scale -1
        halved = (
            f"transform(sequence(0, {(_LAST + 1) // 2}), "
            f"j -> coalesce(get({c}, 2 * j - 1), 0L) + coalesce(get({c}, 2 * j), 0L))"
        )
        return f"CASE WHEN {coarse} THEN {halved} ELSE {c} END"

    return _project(
        running,
        {
            **_metric("event.cents.signed", _BY_SERVICE, "unix_micros(CAST(first_day AS TIMESTAMP)) * 1000", _DAY_END),
            "Count": "n",
            "Sum": "CAST(total AS DOUBLE)",
            "Scale": f"CASE WHEN {coarse} THEN -1 ELSE 0 END",
            "ZeroCount": "zeros",
            "PositiveOffset": str(_FIRST),
            "PositiveBucketCounts": buckets("pos"),
            "NegativeOffset": str(_FIRST),
            "NegativeBucketCounts": buckets("neg"),
            "Exemplars": _NO_EXEMPLARS,
            "Min": "CAST(NULL AS DOUBLE)",
            "Max": "CAST(NULL AS DOUBLE)",
            "AggregationTemporality": str(TEMPORALITY_CUMULATIVE),
        },
    )


def with_exemplars(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Points of the four types that have exemplars; each tells of its first event."""
    exemplar = (
        "array(named_struct('FilteredAttributes', map('k', k), "
        f"'TimeUnix', {sql_timestamp('nanos')}, 'TimeUnixNanos', nanos, "
        f"'Value', CAST(cents AS DOUBLE), 'SpanId', {_span_id('event_id')}, "
        f"'TraceId', {_trace_id('event_id')}))"
    )
    first = (
        events(spark, sf_dir)
        .groupBy(F.col("svc").alias("ServiceName"), F.col("d").alias("EventDate"))
        .agg(F.min("event_id").alias("event_id"))
        .join(events(spark, sf_dir).select("event_id", "nanos", "cents", "k"), "event_id")
        .selectExpr("ServiceName", "EventDate", f"{exemplar} AS Exemplars")
    )

    def told(points: DataFrame) -> DataFrame:
        return points.drop("Exemplars").join(first, ["ServiceName", "EventDate"])

    each = events(spark, sf_dir).selectExpr("nanos", "svc", f"{exemplar} AS Exemplars")
    sums = sum_delta(spark, sf_dir).drop("Exemplars").join(
        each, (F.col("TimeUnixNanos") == F.col("nanos")) & (F.col("ServiceName") == F.col("svc"))
    )
    return {
        "gauge": gauge(spark, sf_dir),
        "sum": sums.drop("nanos", "svc"),
        "histogram": told(histogram(spark, sf_dir)),
        "exponential_histogram": told(exp_histogram(spark, sf_dir)),
    }
