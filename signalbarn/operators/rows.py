"""Projections from flattened batch records to stored rows, details and rejects.

Each projection is a mapping from column to SQL text. Later entries may use
earlier columns.
"""

from __future__ import annotations

from functools import cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from signalbarn.functions.columns import (
    SPAN_KINDS,
    STATUS_CODES,
    attr,
    sql_attrs,
    sql_bad_long,
    sql_enum,
    sql_long,
    sql_series_key,
    sql_text,
    sql_timestamp,
    sql_value,
)
from signalbarn.schemas import BATCHES, CORRUPT, METRIC_TABLES, TABLES

# Wire struct of each metric kind -> stored table and type name.
# The five metric type names of the data model.
METRIC_KINDS = {
    "gauge": ("gauge", "Gauge"),
    "sum": ("sum", "Sum"),
    "histogram": ("histogram", "Histogram"),
    "exponentialHistogram": ("exponential_histogram", "ExponentialHistogram"),
    "summary": ("summary", "Summary"),
}


def _project(df: DataFrame, table: str, columns: dict[str, str]) -> DataFrame:
    """Evaluate the projection, then keep the table's columns in order and type."""
    wanted = StructType.fromDDL(TABLES[table].ddl).fields
    return df.selectExpr(*[f"{sql} AS {name}" for name, sql in columns.items()]).selectExpr(
        *[f"CAST({f.name} AS {f.dataType.simpleString()}) AS {f.name}" for f in wanted]
    )


# Resource and scope columns shared by all signals.
_CONTEXT = {
    "ResourceAttributes": sql_attrs("resource.attributes"),
    "ResourceSchemaUrl": sql_text("resourceSchemaUrl"),
    "ScopeName": sql_text("scope.name"),
    "ScopeVersion": sql_text("scope.version"),
    "ScopeAttributes": sql_attrs("scope.attributes"),
    "ScopeDroppedAttrCount": "coalesce(scope.droppedAttributesCount, 0L)",
    "ScopeSchemaUrl": sql_text("scopeSchemaUrl"),
    "ServiceName": "coalesce(ResourceAttributes['service.name'], '')",
    "ServiceVersion": "coalesce(ResourceAttributes['service.version'], '')",
}


def promote_service(df: DataFrame) -> DataFrame:
    """`ServiceName` and `ServiceVersion` from the resource attributes."""
    return df.withColumns(
        {
            "ServiceName": attr("ResourceAttributes", "service.name"),
            "ServiceVersion": attr("ResourceAttributes", "service.version"),
        }
    )


def _any_bad(items: str, *fields: str) -> str:
    """True when an array holds a malformed 64-bit text, itself or in the given fields."""
    tests = [sql_bad_long(f"x.{f}") for f in fields] or [sql_bad_long("x")]
    return f"coalesce(exists({items}, x -> {' OR '.join(tests)}), false)"


# ---------------------------------------------------------------- logs

_BAD_LOG = " OR ".join(
    [sql_bad_long("record.timeUnixNano"), sql_bad_long("record.observedTimeUnixNano")]
)

_LOG = {
    **_CONTEXT,
    # Without an event time, a log is kept at the time it was observed, not in 1970.
    "TimestampNanos": (
        f"coalesce(nullif({sql_long('record.timeUnixNano')}, 0L), "
        f"{sql_long('record.observedTimeUnixNano')})"
    ),
    "Timestamp": sql_timestamp("TimestampNanos"),
    "ObservedTimestampNanos": sql_long("record.observedTimeUnixNano"),
    "ObservedTimestamp": sql_timestamp("ObservedTimestampNanos"),
    "TraceId": sql_text("record.traceId"),
    "SpanId": sql_text("record.spanId"),
    "TraceFlags": "coalesce(record.flags, 0L)",
    "SeverityText": sql_text("record.severityText"),
    "SeverityNumber": "coalesce(record.severityNumber, 0)",
    "Body": sql_value("record.body"),
    "LogAttributes": sql_attrs("record.attributes"),
    "LogDroppedAttrCount": "coalesce(record.droppedAttributesCount, 0L)",
}


def to_logs_rows(records: DataFrame) -> DataFrame:
    """Flattened log records to the logs schema; unreadable ones go to `log_rejects`."""
    return _project(records.filter(f"NOT ({_BAD_LOG})"), "logs", _LOG)


def log_detail(logs: DataFrame) -> DataFrame:
    return logs.select(
        F.col("SeverityText").alias("severity"),
        F.col("Body").alias("body"),
        F.col("TimestampNanos").alias("timestamp_nanos"),
    )


# ---------------------------------------------------------------- spans

_BAD_SPAN = " OR ".join(
    [
        sql_bad_long("record.startTimeUnixNano"),
        sql_bad_long("record.endTimeUnixNano"),
        _any_bad("record.events", "timeUnixNano"),
    ]
)
_SIGNED_DURATION = (
    f"{sql_long('record.endTimeUnixNano')} - {sql_long('record.startTimeUnixNano')}"
)
_EVENT = (
    f"named_struct('Timestamp', {sql_timestamp(sql_long('e.timeUnixNano'))}, "
    f"'TimestampNanos', {sql_long('e.timeUnixNano')}, 'Name', {sql_text('e.name')}, "
    f"'Attributes', {sql_attrs('e.attributes')})"
)
_LINK = (
    f"named_struct('TraceId', {sql_text('x.traceId')}, 'SpanId', {sql_text('x.spanId')}, "
    f"'TraceState', {sql_text('x.traceState')}, 'Attributes', {sql_attrs('x.attributes')})"
)

_SPAN = {
    **_CONTEXT,
    "TimestampNanos": sql_long("record.startTimeUnixNano"),
    "Timestamp": sql_timestamp("TimestampNanos"),
    "TraceId": sql_text("record.traceId"),
    "SpanId": sql_text("record.spanId"),
    "ParentSpanId": sql_text("record.parentSpanId"),
    "TraceState": sql_text("record.traceState"),
    "SpanName": sql_text("record.name"),
    "SpanKind": sql_enum("record.kind", SPAN_KINDS),
    "SpanAttributes": sql_attrs("record.attributes"),
    # The stored duration is unsigned.
    "Duration": f"greatest({_SIGNED_DURATION}, 0L)",
    "StatusCode": sql_enum("record.status.code", STATUS_CODES),
    "StatusMessage": sql_text("record.status.message"),
    "Events": f"coalesce(transform(record.events, e -> {_EVENT}), array())",
    "Links": f"coalesce(transform(record.links, x -> {_LINK}), array())",
}


def to_span_rows(records: DataFrame) -> DataFrame:
    """Flattened spans to the traces schema; a negative duration is stored as 0."""
    return _project(records.filter(f"NOT ({_BAD_SPAN})"), "traces", _SPAN)


def span_detail(records: DataFrame) -> DataFrame:
    """Received spans as ids, name, kind and signed duration (end - start)."""
    return records.filter(f"NOT ({_BAD_SPAN})").selectExpr(
        f"{sql_text('record.spanId')} AS span_id",
        f"{sql_text('record.traceId')} AS trace_id",
        f"{sql_text('record.name')} AS name",
        f"{sql_enum('record.kind', SPAN_KINDS)} AS kind",
        f"{_SIGNED_DURATION} AS duration",
    )


# ---------------------------------------------------------------- metrics


def metric_type() -> Column:
    """Type name from the one sub-struct that is present; "Empty" without any."""
    kinds = [
        F.when(F.col(f"record.{wire}").isNotNull(), F.lit(name))
        for wire, (_, name) in METRIC_KINDS.items()
    ]
    return F.coalesce(*kinds, F.lit("Empty"))


def metric_detail(records: DataFrame) -> DataFrame:
    return records.select(
        F.expr(sql_text("record.name")).alias("name"),
        F.expr(sql_text("record.description")).alias("description"),
        F.expr(sql_text("record.unit")).alias("unit"),
        metric_type().alias("type"),
    )


def data_points(records: DataFrame, wire: str) -> DataFrame:
    """One row per data point of one metric kind (`gauge`, `sum`, `histogram`, ...)."""
    timed = wire not in ("gauge", "summary")
    return records.filter(f"record.{wire} IS NOT NULL").selectExpr(
        "resource",
        "resourceSchemaUrl",
        "scope",
        "scopeSchemaUrl",
        "record.name AS name",
        "record.description AS description",
        "record.unit AS unit",
        f"{f'record.{wire}.aggregationTemporality' if timed else '0'} AS temporality",
        f"{'record.sum.isMonotonic' if wire == 'sum' else 'false'} AS monotonic",
        f"explode(record.{wire}.dataPoints) AS p",
    )


_EXEMPLAR = (
    f"named_struct('FilteredAttributes', {sql_attrs('e.filteredAttributes')}, "
    f"'TimeUnix', {sql_timestamp(sql_long('e.timeUnixNano'))}, "
    f"'TimeUnixNanos', {sql_long('e.timeUnixNano')}, "
    "'Value', coalesce(e.asDouble, try_cast(e.asInt AS DOUBLE)), "
    f"'SpanId', {sql_text('e.spanId')}, 'TraceId', {sql_text('e.traceId')})"
)
_EXEMPLARS = f"coalesce(transform(p.exemplars, e -> {_EXEMPLAR}), array())"

_POINT = {
    **_CONTEXT,
    "MetricName": sql_text("name"),
    "MetricDescription": sql_text("description"),
    "MetricUnit": sql_text("unit"),
    "Attributes": sql_attrs("p.attributes"),
    "SeriesKey": sql_series_key("Attributes"),
    "StartTimeUnixNanos": sql_long("p.startTimeUnixNano"),
    "StartTimeUnix": sql_timestamp("StartTimeUnixNanos"),
    "TimeUnixNanos": sql_long("p.timeUnixNano"),
    "TimeUnix": sql_timestamp("TimeUnixNanos"),
    "Flags": "coalesce(p.flags, 0L)",
    "AggregationTemporality": "coalesce(temporality, 0)",
    "IsMonotonic": "coalesce(monotonic, false)",
}


def _longs(items: str) -> str:
    return f"coalesce(transform({items}, x -> {sql_long('x')}), array())"


# A point without a value says so in its flags; it is no 0.
_NUMBER = {
    **_POINT,
    "Value": "coalesce(p.asDouble, try_cast(p.asInt AS DOUBLE))",
    "Exemplars": _EXEMPLARS,
}
_DISTRIBUTION = {
    **_POINT,
    "Count": sql_long("p.count"),
    "Sum": "coalesce(p.sum, 0D)",
}
# Absent Min and Max stay NULL, so that they are no false minima.
_MEASURED = {**_DISTRIBUTION, "Exemplars": _EXEMPLARS, "Min": "p.min", "Max": "p.max"}

_POINT_COLUMNS = {
    "gauge": _NUMBER,
    "sum": _NUMBER,
    "histogram": {
        **_MEASURED,
        "BucketCounts": _longs("p.bucketCounts"),
        "ExplicitBounds": "coalesce(p.explicitBounds, array())",
    },
    "exponentialHistogram": {
        **_MEASURED,
        "Scale": "coalesce(p.scale, 0)",
        "ZeroCount": sql_long("p.zeroCount"),
        "PositiveOffset": "coalesce(p.positive.offset, 0)",
        "PositiveBucketCounts": _longs("p.positive.bucketCounts"),
        "NegativeOffset": "coalesce(p.negative.offset, 0)",
        "NegativeBucketCounts": _longs("p.negative.bucketCounts"),
    },
    "summary": {
        **_DISTRIBUTION,
        "ValueAtQuantiles": (
            "coalesce(transform(p.quantileValues, "
            "v -> named_struct('Quantile', v.quantile, 'Value', v.value)), array())"
        ),
    },
}

_BAD_TIMES = [sql_bad_long("p.startTimeUnixNano"), sql_bad_long("p.timeUnixNano")]
_BAD_EXEMPLARS = _any_bad("p.exemplars", "timeUnixNano", "asInt")
_BAD_COUNT = sql_bad_long("p.count")
# One more bucket than bounds; both absent (only count and sum recorded) is allowed.
_BAD_LENGTH = (
    "NOT (coalesce(size(p.bucketCounts), 0) = 0 AND coalesce(size(p.explicitBounds), 0) = 0) "
    "AND coalesce(size(p.bucketCounts), 0) <> coalesce(size(p.explicitBounds), 0) + 1"
)
_BAD_POINT = {
    wire: " OR ".join(f"({test})" for test in [*_BAD_TIMES, *tests])
    for wire, tests in {
        "gauge": [sql_bad_long("p.asInt"), _BAD_EXEMPLARS],
        "sum": [sql_bad_long("p.asInt"), _BAD_EXEMPLARS],
        "histogram": [_BAD_COUNT, _any_bad("p.bucketCounts"), _BAD_LENGTH, _BAD_EXEMPLARS],
        "exponentialHistogram": [
            _BAD_COUNT,
            sql_bad_long("p.zeroCount"),
            _any_bad("p.positive.bucketCounts"),
            _any_bad("p.negative.bucketCounts"),
            _BAD_EXEMPLARS,
        ],
        "summary": [_BAD_COUNT],
    }.items()
}


def _point_rows(records: DataFrame, wire: str) -> DataFrame:
    good = data_points(records, wire).filter(f"NOT ({_BAD_POINT[wire]})")
    return _project(good, METRIC_KINDS[wire][0], _POINT_COLUMNS[wire])


@cache
def _point_fields() -> dict[str, dict[str, str]]:
    """Names and types of the fields of each kind of data point."""
    shape = BATCHES["metrics"]
    resources = StructType.fromDDL(shape.ddl)[shape.resources].dataType.elementType
    metric = resources[shape.scopes].dataType.elementType[shape.records].dataType.elementType
    return {
        wire: {f.name: f.dataType.simpleString() for f in metric[wire].dataType["dataPoints"].dataType.elementType}
        for wire in METRIC_KINDS
    }


def all_points(records: DataFrame) -> DataFrame:
    """One row per data point of any kind, from one pass over the records; `kind` tells which.

    Points have the fields of all kinds, so that they fit one column.
    """
    every = {name: kind for own in _point_fields().values() for name, kind in own.items()}
    arrays = []
    for wire, own in _point_fields().items():
        fields = ", ".join(
            f"'{name}', {f'x.{name}' if name in own else f'CAST(NULL AS {kind})'}"
            for name, kind in every.items()
        )
        temporality = "NULL" if wire in ("gauge", "summary") else f"record.{wire}.aggregationTemporality"
        arrays.append(
            f"coalesce(transform(record.{wire}.dataPoints, x -> named_struct('kind', '{wire}', "
            f"'temporality', CAST({temporality} AS INT), "
            f"'monotonic', {'record.sum.isMonotonic' if wire == 'sum' else 'false'}, "
            f"'p', named_struct({fields}))), array())"
        )
    kept = [CORRUPT] if CORRUPT in records.columns else []
    how = "explode_outer" if kept else "explode"
    points = records.selectExpr(
        *kept,
        "resource",
        "resourceSchemaUrl",
        "scope",
        "scopeSchemaUrl",
        "record.name AS name",
        "record.description AS description",
        "record.unit AS unit",
        f"{how}(concat({', '.join(arrays)})) AS _point",
    )
    points = points.selectExpr(
        *[c for c in points.columns if c != "_point"],
        *[f"_point.{c} AS {c}" for c in ("kind", "temporality", "monotonic", "p")],
    )
    return points.filter(f"kind IS NOT NULL OR {CORRUPT} IS NOT NULL") if kept else points


def to_gauge_rows(records: DataFrame) -> DataFrame:
    return _point_rows(records, "gauge")


def to_sum_rows(records: DataFrame) -> DataFrame:
    return _point_rows(records, "sum")


def to_histogram_rows(records: DataFrame) -> DataFrame:
    """Points whose bucket and bound counts do not fit are rejected."""
    return _point_rows(records, "histogram")


def to_exp_histogram_rows(records: DataFrame) -> DataFrame:
    return _point_rows(records, "exponentialHistogram")


def to_summary_rows(records: DataFrame) -> DataFrame:
    return _point_rows(records, "summary")


METRIC_ROWS = {
    "gauge": to_gauge_rows,
    "sum": to_sum_rows,
    "histogram": to_histogram_rows,
    "exponential_histogram": to_exp_histogram_rows,
    "summary": to_summary_rows,
}


def route_metrics(records: DataFrame) -> dict[str, DataFrame]:
    """Metric records split by type into the rows of the five metrics tables."""
    return {table: METRIC_ROWS[table](records) for table in METRIC_TABLES}


# ---------------------------------------------------------------- rejects


_UNFIT = "integer out of range or array lengths that do not fit"


def _reject(df: DataFrame, level: str, *parts: str) -> DataFrame:
    return df.selectExpr(
        f"'{level}' AS Level",
        f"'{_UNFIT}' AS Reason",
        f"to_json(struct({', '.join(parts)})) AS Raw",
    )


def log_rejects(records: DataFrame) -> DataFrame:
    return _reject(records.filter(_BAD_LOG), "record", "resource", "scope", "record")


def span_rejects(records: DataFrame) -> DataFrame:
    return _reject(records.filter(_BAD_SPAN), "record", "resource", "scope", "record")


def point_rejects(records: DataFrame) -> DataFrame:
    """Data points that no metrics table can hold."""
    out = None
    for wire in METRIC_KINDS:
        bad = data_points(records, wire).filter(_BAD_POINT[wire])
        part = _reject(bad, "point", "resource", "scope", "name", "p")
        out = part if out is None else out.unionByName(part)
    return out


# ---------------------------------------------------------------- rows and rejects from one pass

#: What becomes of a record: a row of `Kind`, or a reject of one of these levels.
ROW, BAD_LINE = "row", "line"
REJECT = "Level STRING, Reason STRING, Raw STRING"


def tagged_rows(records: DataFrame, signal: str) -> DataFrame:
    """Every record (for metrics: every data point) once, as a row or as a reject.

    `Outcome` is "row" for what `Kind`'s table can hold, else the reject's
    level; `Reason` and `Raw` belong to rejects. The other columns are those of
    the signal's tables. Records that carry the corrupt column of their line,
    see `flatten_all`, give one reject per malformed line.
    """
    if signal == "metrics":
        df = all_points(records)
        kind = "CASE kind " + " ".join(f"WHEN '{w}' THEN '{t}'" for w, (t, _) in METRIC_KINDS.items()) + " END"
        bad = "CASE kind " + " ".join(f"WHEN '{w}' THEN {t}" for w, t in _BAD_POINT.items()) + " ELSE false END"
        level, raw, tables = "point", "resource, scope, name, p", METRIC_TABLES
        columns = {c: sql for own in _POINT_COLUMNS.values() for c, sql in own.items()}
    else:
        df, kind, level, raw, tables = records, f"'{signal}'", "record", "resource, scope, record", (signal,)
        bad, columns = {"logs": (_BAD_LOG, _LOG), "traces": (_BAD_SPAN, _SPAN)}[signal]
    line = f"{CORRUPT} IS NOT NULL" if CORRUPT in df.columns else "false"
    corrupt = CORRUPT if CORRUPT in df.columns else "CAST(NULL AS STRING)"
    outcome = f"CASE WHEN {line} THEN '{BAD_LINE}' WHEN {bad} THEN '{level}' ELSE '{ROW}' END"
    tags = {
        "Outcome": outcome,
        "Kind": f"CASE WHEN {line} THEN 'none' ELSE {kind} END",
        "Reason": f"CASE Outcome WHEN '{ROW}' THEN NULL WHEN '{BAD_LINE}' THEN 'malformed batch line' ELSE '{_UNFIT}' END",
        "Raw": f"CASE Outcome WHEN '{ROW}' THEN NULL WHEN '{BAD_LINE}' THEN {corrupt} ELSE to_json(struct({raw})) END",
    }
    fields = {f.name: f for t in tables for f in StructType.fromDDL(TABLES[t].ddl).fields}
    return df.selectExpr(*[f"{sql} AS {name}" for name, sql in {**tags, **columns}.items()]).selectExpr(
        *tags, *[f"CAST({f.name} AS {f.dataType.simpleString()}) AS {f.name}" for f in fields.values()]
    )
