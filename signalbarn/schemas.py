"""Schemas of the nested batches and of the eight stored tables.

A nanosecond time is two columns: `X TIMESTAMP` (microseconds, for dates and
windows) and `XNanos BIGINT` (exact, for ordering and arithmetic).
"""

from __future__ import annotations

from dataclasses import dataclass, field

ATTR = "MAP<STRING,STRING>"

# ---------------------------------------------------------------- batches

KV = "STRUCT<key STRING, value VARIANT>"
_KVS = f"ARRAY<{KV}>"
_RES = f"STRUCT<attributes {_KVS}>"
_SCOPE = (
    f"STRUCT<name STRING, version STRING, attributes {_KVS}, droppedAttributesCount BIGINT>"
)
_EX = (
    f"STRUCT<filteredAttributes {_KVS}, timeUnixNano STRING, asDouble DOUBLE, "
    "asInt STRING, spanId STRING, traceId STRING>"
)
_POINT = (
    f"attributes {_KVS}, startTimeUnixNano STRING, timeUnixNano STRING, flags BIGINT"
)
_NUM = f"STRUCT<{_POINT}, asDouble DOUBLE, asInt STRING, exemplars ARRAY<{_EX}>>"
_HIST = (
    f"STRUCT<{_POINT}, count STRING, sum DOUBLE, bucketCounts ARRAY<STRING>, "
    f"explicitBounds ARRAY<DOUBLE>, min DOUBLE, max DOUBLE, exemplars ARRAY<{_EX}>>"
)
_SIDE = "STRUCT<offset INT, bucketCounts ARRAY<STRING>>"
_EXP = (
    f"STRUCT<{_POINT}, count STRING, sum DOUBLE, scale INT, zeroCount STRING, "
    f"positive {_SIDE}, negative {_SIDE}, min DOUBLE, max DOUBLE, exemplars ARRAY<{_EX}>>"
)
_SUMM = (
    f"STRUCT<{_POINT}, count STRING, sum DOUBLE, "
    "quantileValues ARRAY<STRUCT<quantile DOUBLE, value DOUBLE>>>"
)

_LOG_RECORD = (
    "STRUCT<timeUnixNano STRING, observedTimeUnixNano STRING, severityNumber INT, "
    f"severityText STRING, body VARIANT, attributes {_KVS}, "
    "droppedAttributesCount BIGINT, flags BIGINT, traceId STRING, spanId STRING>"
)
_SPAN = (
    "STRUCT<traceId STRING, spanId STRING, parentSpanId STRING, traceState STRING, "
    "name STRING, kind INT, startTimeUnixNano STRING, endTimeUnixNano STRING, "
    f"attributes {_KVS}, "
    f"events ARRAY<STRUCT<timeUnixNano STRING, name STRING, attributes {_KVS}>>, "
    f"links ARRAY<STRUCT<traceId STRING, spanId STRING, traceState STRING, attributes {_KVS}>>, "
    "status STRUCT<code INT, message STRING>>"
)
_METRIC = (
    "STRUCT<name STRING, description STRING, unit STRING, "
    f"gauge STRUCT<dataPoints ARRAY<{_NUM}>>, "
    f"sum STRUCT<dataPoints ARRAY<{_NUM}>, aggregationTemporality INT, isMonotonic BOOLEAN>, "
    f"histogram STRUCT<dataPoints ARRAY<{_HIST}>, aggregationTemporality INT>, "
    f"exponentialHistogram STRUCT<dataPoints ARRAY<{_EXP}>, aggregationTemporality INT>, "
    f"summary STRUCT<dataPoints ARRAY<{_SUMM}>>>"
)

# A line that is not valid JSON, or whose fields have the wrong kind, is kept whole here.
CORRUPT = "_corrupt_record"


def _batch(resources: str, scopes: str, records: str, record: str) -> str:
    return (
        f"{resources} ARRAY<STRUCT<resource {_RES}, schemaUrl STRING, "
        f"{scopes} ARRAY<STRUCT<scope {_SCOPE}, schemaUrl STRING, "
        f"{records} ARRAY<{record}>>>>>, {CORRUPT} STRING"
    )


@dataclass(frozen=True)
class BatchShape:
    """Names of the three nesting levels of one signal's batches."""

    resources: str
    scopes: str
    records: str
    ddl: str


BATCHES = {
    "logs": BatchShape(
        "resourceLogs", "scopeLogs", "logRecords",
        _batch("resourceLogs", "scopeLogs", "logRecords", _LOG_RECORD),
    ),
    "traces": BatchShape(
        "resourceSpans", "scopeSpans", "spans",
        _batch("resourceSpans", "scopeSpans", "spans", _SPAN),
    ),
    "metrics": BatchShape(
        "resourceMetrics", "scopeMetrics", "metrics",
        _batch("resourceMetrics", "scopeMetrics", "metrics", _METRIC),
    ),
}

# ---------------------------------------------------------------- tables

EVENTS = (
    f"ARRAY<STRUCT<Timestamp TIMESTAMP, TimestampNanos BIGINT, Name STRING, Attributes {ATTR}>>"
)
LINKS = f"ARRAY<STRUCT<TraceId STRING, SpanId STRING, TraceState STRING, Attributes {ATTR}>>"
EXEMPLARS = (
    f"ARRAY<STRUCT<FilteredAttributes {ATTR}, TimeUnix TIMESTAMP, TimeUnixNanos BIGINT, "
    "Value DOUBLE, SpanId STRING, TraceId STRING>>"
)
QUANTILES = "ARRAY<STRUCT<Quantile DOUBLE, Value DOUBLE>>"

LOGS = f"""
  Timestamp TIMESTAMP, TimestampNanos BIGINT,
  ObservedTimestamp TIMESTAMP, ObservedTimestampNanos BIGINT,
  TraceId STRING, SpanId STRING, TraceFlags BIGINT,
  SeverityText STRING, SeverityNumber INT,
  ServiceName STRING, ServiceVersion STRING, Body STRING,
  ResourceAttributes {ATTR}, ResourceSchemaUrl STRING,
  ScopeName STRING, ScopeVersion STRING, ScopeAttributes {ATTR},
  ScopeDroppedAttrCount BIGINT, ScopeSchemaUrl STRING,
  LogAttributes {ATTR}, LogDroppedAttrCount BIGINT
"""

TRACES = f"""
  Timestamp TIMESTAMP, TimestampNanos BIGINT,
  TraceId STRING, SpanId STRING, ParentSpanId STRING, TraceState STRING,
  SpanName STRING, SpanKind STRING, ServiceName STRING,
  ResourceAttributes {ATTR}, ScopeName STRING, ScopeVersion STRING,
  SpanAttributes {ATTR}, Duration BIGINT,
  StatusCode STRING, StatusMessage STRING,
  Events {EVENTS}, Links {LINKS}
"""

LOOKUP = "TraceId STRING, Start TIMESTAMP, End TIMESTAMP"

# SeriesKey is the order-independent text of Attributes; maps cannot be
# sorted, windowed or joined on, so it is computed once, when a row is made.
_METRIC_PREFIX = f"""
  ResourceAttributes {ATTR}, ResourceSchemaUrl STRING,
  ScopeName STRING, ScopeVersion STRING, ScopeAttributes {ATTR},
  ScopeDroppedAttrCount BIGINT, ScopeSchemaUrl STRING,
  ServiceName STRING, MetricName STRING, MetricDescription STRING, MetricUnit STRING,
  Attributes {ATTR}, SeriesKey STRING,
  StartTimeUnix TIMESTAMP, StartTimeUnixNanos BIGINT,
  TimeUnix TIMESTAMP, TimeUnixNanos BIGINT
"""
_NUMBER = (
    f"Value DOUBLE, Flags BIGINT, Exemplars {EXEMPLARS}, "
    "AggregationTemporality INT, IsMonotonic BOOLEAN"
)

GAUGE = f"{_METRIC_PREFIX}, {_NUMBER}"
SUM = f"{_METRIC_PREFIX}, {_NUMBER}"
HISTOGRAM = f"""{_METRIC_PREFIX},
  Count BIGINT, Sum DOUBLE, BucketCounts ARRAY<BIGINT>, ExplicitBounds ARRAY<DOUBLE>,
  Exemplars {EXEMPLARS}, Flags BIGINT, Min DOUBLE, Max DOUBLE, AggregationTemporality INT
"""
EXP_HISTOGRAM = f"""{_METRIC_PREFIX},
  Count BIGINT, Sum DOUBLE, Scale INT, ZeroCount BIGINT,
  PositiveOffset INT, PositiveBucketCounts ARRAY<BIGINT>,
  NegativeOffset INT, NegativeBucketCounts ARRAY<BIGINT>,
  Exemplars {EXEMPLARS}, Flags BIGINT, Min DOUBLE, Max DOUBLE, AggregationTemporality INT
"""
SUMMARY = f"""{_METRIC_PREFIX},
  Count BIGINT, Sum DOUBLE, ValueAtQuantiles {QUANTILES}, Flags BIGINT
"""


@dataclass(frozen=True)
class TableSpec:
    """Schema and physical layout of one stored table."""

    name: str
    ddl: str
    time: str
    day: str = "EventDate"
    sort: tuple[str, ...] = ()
    # column -> false-positive rate of its Parquet Bloom filter
    bloom: dict[str, float] = field(default_factory=dict)


_SERIES_SORT = ("ServiceName", "MetricName", "SeriesKey", "TimeUnixNanos")


def _metric(name: str, ddl: str) -> TableSpec:
    return TableSpec(name, ddl, "TimeUnix", sort=_SERIES_SORT)


# Default table names, sort keys and filter rates of the data model.
TABLES = {
    "logs": TableSpec(
        "otel_logs", LOGS, "Timestamp",
        sort=("ServiceName", "SeverityNumber", "TimestampNanos", "TraceId"),
        bloom={"TraceId": 0.01, "SpanId": 0.01},
    ),
    "traces": TableSpec(
        "otel_traces", TRACES, "Timestamp",
        sort=("ServiceName", "SpanName", "TimestampNanos"),
        bloom={"TraceId": 0.001},
    ),
    "lookup": TableSpec(
        "otel_traces_trace_id_ts", LOOKUP, "Start", day="StartDate",
        sort=("TraceId", "Start"), bloom={"TraceId": 0.01},
    ),
    "gauge": _metric("otel_metrics_gauge", GAUGE),
    "sum": _metric("otel_metrics_sum", SUM),
    "histogram": _metric("otel_metrics_histogram", HISTOGRAM),
    "exponential_histogram": _metric("otel_metrics_exponential_histogram", EXP_HISTOGRAM),
    "summary": _metric("otel_metrics_summary", SUMMARY),
}

# Lookups of our own that are stored like the tables but are not part of the data model.
LOOKUPS = {
    "token_days": TableSpec(
        "token_days", "Token STRING", "EventDate", sort=("Token",), bloom={"Token": 0.01}
    ),
}

METRIC_TABLES = ("gauge", "sum", "histogram", "exponential_histogram", "summary")

# Aggregation temporality codes.
TEMPORALITY_UNSPECIFIED = 0
TEMPORALITY_DELTA = 1
TEMPORALITY_CUMULATIVE = 2
