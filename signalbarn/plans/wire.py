"""Nested JSON batches made from the derived inputs, to feed the batch readers.

A batch of logs or spans holds 40 consecutive events, grouped by resource, so
that no group grows with the data. A batch of metrics holds one metric; those of
`write_mixed_metric_batches` hold several, with several points each. With
`damaged`, every fifth batch is cut off and every eleventh record unfit.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from signalbarn.functions.files import Store
from signalbarn.plans import inputs

_BATCH = "event_id div 40 AS _batch"
#: In damaged batches: lines cut off in the middle, and integers beyond 64 bits.
CUT_OFF = "_batch % 5 = 3"
_UNFIT = "event_id % 11 = 4"
_TOO_LARGE = "'9223372036854775808'"


def _struct(**fields: str) -> str:
    return "named_struct(" + ", ".join(f"'{k}', {v}" for k, v in fields.items()) + ")"


def _kv(key: str, kind: str, value: str) -> str:
    """A key with one value; the other value kinds are NULL and left out of the JSON."""
    kinds = {"stringValue": "STRING", "intValue": "STRING", "boolValue": "BOOLEAN"}
    values = {k: f"CAST({value if k == kind else 'NULL'} AS {t})" for k, t in kinds.items()}
    return _struct(key=f"'{key}'", value=_struct(**values))


def _attrs(*kvs: str) -> str:
    return f"array({', '.join(kvs)})"


def _digits(c: str) -> str:
    return f"CAST({c} AS STRING)"


def _fit(c: str, damaged: bool) -> str:
    return f"CASE WHEN {_UNFIT} THEN {_TOO_LARGE} ELSE {_digits(c)} END" if damaged else _digits(c)


#: Records in a file at most, whatever a line holds, and events in a batch of logs, spans or mixed metrics.
_RECORDS_PER_FILE, _EVENTS_PER_BATCH = 400_000, 40
#: Stored bytes of events that one task makes into batches.
_TASK_BYTES = 4 * 1024 * 1024


def _write(lines: DataFrame, path: str, files: int | None, per_line: int, compression: str) -> str:
    """As many files as tasks, or for tests of small streams a given number.

    The text takes ten times the room of its events, so it is compressed, lightly.
    Streams take a few files at a time; theirs are not, so that tasks can share them.
    """
    lines = lines.repartition(files) if files else lines
    writer = lines.write.option("maxRecordsPerFile", _RECORDS_PER_FILE // per_line)
    writer.options(**{"compression": compression, "zlib.compress.level": "BEST_SPEED"}).text(path)
    return path


def _batched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events with the number of their batch, each batch in one task.

    This is the only shuffle on the way to batches, and of the few columns that
    records are made of. Records are far wider, so the number of tasks follows
    the size of the table and not what is shuffled.
    """
    size = sum(n for _, n in Store(spark, sf_dir).files(f"{sf_dir}/events.parquet"))
    tasks = max(spark.sparkContext.defaultParallelism, -(-size // _TASK_BYTES))
    return inputs.events(spark, sf_dir).selectExpr("*", _BATCH).repartition(tasks, "_batch")


def _lines(
    rows: DataFrame,
    record: str,
    resource: str,
    names: tuple[str, str, str],
    keys: list[str],
    damaged: bool = False,
    together: str = "_records",
) -> DataFrame:
    """Rows to one JSON line per batch; `together` makes the records of one resource from all its rows'.

    Rows of `_batched` are grouped where they are: both groupings keep to their batches.
    """
    resources, scopes, records = names
    scope = _struct(name="'events'", version="'1'")
    entry = _struct(
        resource=_struct(attributes=resource),
        **{scopes: f"array({_struct(scope=scope, **{records: together})})"},
    )
    line = f"to_json(struct({resources}))"
    if damaged:
        line = f"CASE WHEN {CUT_OFF} THEN left({line}, length({line}) div 2) ELSE {line} END"
    return (
        rows.groupBy("_batch", *keys)
        .agg(F.expr(f"collect_list({record}) AS _records"))
        .groupBy("_batch")
        .agg(F.expr(f"collect_list({entry}) AS {resources}"))
        .selectExpr(f"{line} AS value")
    )


def write_log_batches(
    spark: SparkSession,
    sf_dir: str,
    path: str,
    files: int | None = None,
    damaged: bool = False,
    compression: str = "gzip",
) -> str:
    rows = inputs.logs_of(_batched(spark, sf_dir), "_batch", "event_id")
    record = _struct(
        timeUnixNano=_fit("TimestampNanos", damaged),
        observedTimeUnixNano=_digits("ObservedTimestampNanos"),
        severityNumber="SeverityNumber",
        severityText="SeverityText",
        body=_struct(stringValue="Body"),
        attributes=_attrs(
            _kv("event_type", "stringValue", "LogAttributes['event_type']"),
            _kv("k", "intValue", "LogAttributes['k']"),
            _kv("bare", "boolValue", "TraceId = ''"),
        ),
        traceId="TraceId",
        spanId="SpanId",
    )
    resource = _attrs(
        _kv("service.name", "stringValue", "ServiceName"),
        _kv("service.version", "stringValue", "ServiceVersion"),
    )
    names = ("resourceLogs", "scopeLogs", "logRecords")
    lines = _lines(rows, record, resource, names, ["ServiceName", "ServiceVersion"], damaged)
    return _write(lines, path, files, _EVENTS_PER_BATCH, compression)


def write_span_batches(
    spark: SparkSession,
    sf_dir: str,
    path: str,
    files: int | None = None,
    damaged: bool = False,
    compression: str = "gzip",
) -> str:
    rows = inputs.spans_of(_batched(spark, sf_dir), "_batch", "event_id")
    event = _struct(
        timeUnixNano=_digits("e.TimestampNanos"),
        name="e.Name",
        attributes=_attrs(_kv("exception.type", "stringValue", "e.Attributes['exception.type']")),
    )
    link = _struct(traceId="x.TraceId", spanId="x.SpanId")
    # Wire codes of span kinds and status codes.
    kind = "CASE SpanKind WHEN 'Server' THEN 2 WHEN 'Client' THEN 3 ELSE 1 END"
    status = "CASE StatusCode WHEN 'Ok' THEN 1 WHEN 'Error' THEN 2 ELSE 0 END"
    record = _struct(
        traceId="TraceId",
        spanId="SpanId",
        parentSpanId="ParentSpanId",
        name="SpanName",
        kind=kind,
        startTimeUnixNano=_digits("TimestampNanos"),
        endTimeUnixNano=_fit("TimestampNanos + Duration", damaged),
        attributes=_attrs(_kv("k", "intValue", "SpanAttributes['k']")),
        events=f"transform(Events, e -> {event})",
        links=f"transform(Links, x -> {link})",
        status=_struct(code=status),
    )
    resource = _attrs(_kv("service.name", "stringValue", "ServiceName"))
    names = ("resourceSpans", "scopeSpans", "spans")
    lines = _lines(rows, record, resource, names, ["ServiceName"], damaged)
    return _write(lines, path, files, _EVENTS_PER_BATCH, compression)


# ---------------------------------------------------------------- metrics


def _points(**fields: str) -> str:
    attribute = _struct(key="e.key", value=_struct(stringValue="e.value"))
    point = _struct(
        attributes=f"transform(map_entries(Attributes), e -> {attribute})",
        startTimeUnixNano=_digits("StartTimeUnixNanos"),
        timeUnixNano=_digits("TimeUnixNanos"),
        **fields,
    )
    return f"array({point})"


def _texts(c: str) -> str:
    return f"transform({c}, n -> CAST(n AS STRING))"


def _metric_lines(rows: DataFrame, wire: str, body: str) -> DataFrame:
    """One batch line per metric row."""
    metric = _struct(name="MetricName", unit="MetricUnit", **{wire: body})
    scope = _struct(scope=_struct(name="'events'"), metrics=f"array({metric})")
    entry = _struct(
        resource=_struct(attributes=_attrs(_kv("service.name", "stringValue", "ServiceName"))),
        scopeMetrics=f"array({scope})",
    )
    return rows.selectExpr(f"to_json(named_struct('resourceMetrics', array({entry}))) AS value")


def write_metric_batches(
    spark: SparkSession, sf_dir: str, path: str, files: int | None = None, compression: str = "gzip"
) -> str:
    exemplar = _struct(
        timeUnixNano=_digits("x.TimeUnixNanos"),
        asDouble="x.Value",
        spanId="x.SpanId",
        traceId="x.TraceId",
    )
    positive = _struct(offset="PositiveOffset", bucketCounts=_texts("PositiveBucketCounts"))
    quantile = _struct(quantile="q.Quantile", value="q.Value")
    temporality = {"aggregationTemporality": "AggregationTemporality"}
    shared = {"count": _digits("Count"), "sum": "Sum"}
    low_high = {"min": "Min", "max": "Max"}
    bodies = {
        "gauge": (
            inputs.gauge,
            {
                "dataPoints": _points(
                    asDouble="Value", exemplars=f"transform(Exemplars, x -> {exemplar})"
                )
            },
        ),
        "sum": (
            inputs.sum_delta,
            {
                "dataPoints": _points(asInt=_digits("CAST(Value AS BIGINT)")),
                **temporality,
                "isMonotonic": "IsMonotonic",
            },
        ),
        "histogram": (
            inputs.histogram,
            {
                "dataPoints": _points(
                    **shared,
                    bucketCounts=_texts("BucketCounts"),
                    explicitBounds="ExplicitBounds",
                    **low_high,
                ),
                **temporality,
            },
        ),
        "exponentialHistogram": (
            inputs.exp_histogram,
            {
                "dataPoints": _points(
                    **shared,
                    scale="Scale",
                    zeroCount=_digits("ZeroCount"),
                    positive=positive,
                    **low_high,
                ),
                **temporality,
            },
        ),
        "summary": (
            inputs.summary,
            {
                "dataPoints": _points(
                    **shared, quantileValues=f"transform(ValueAtQuantiles, q -> {quantile})"
                )
            },
        ),
    }
    lines = None
    for wire, (source, body) in bodies.items():
        part = _metric_lines(source(spark, sf_dir), wire, _struct(**body))
        lines = part if lines is None else lines.unionByName(part)
    return _write(lines, path, files, 1, compression)


def write_mixed_metric_batches(
    spark: SparkSession,
    sf_dir: str,
    path: str,
    files: int | None = None,
    damaged: bool = False,
    compression: str = "gzip",
) -> str:
    """Batches whose resources hold a gauge, a sum and a histogram with a point per event.

    With `damaged`, unfit sums hold integers beyond 64 bits, and every
    thirteenth histogram has as many buckets as bounds.
    """
    rows = _batched(spark, sf_dir)
    times = {"startTimeUnixNano": _digits("nanos"), "timeUnixNano": _digits("nanos")}
    exemplar = _struct(timeUnixNano=_digits("nanos"), asDouble="CAST(cents AS DOUBLE)")
    short = "event_id % 13 = 5" if damaged else "false"
    record = _struct(
        gauge=_struct(**times, asDouble="CAST(cents AS DOUBLE)", exemplars=f"array({exemplar})"),
        sum=_struct(**times, asInt=_fit("cents", damaged)),
        histogram=_struct(
            **times,
            count="'1'",
            sum="CAST(cents AS DOUBLE)",
            bucketCounts=f"CASE WHEN {short} THEN array('1') WHEN cents <= 1000 THEN array('1', '0') ELSE array('0', '1') END",
            explicitBounds="array(1000D)",
        ),
    )
    kinds = {
        "gauge": _struct(dataPoints="_records.gauge"),
        "sum": _struct(dataPoints="_records.sum", aggregationTemporality="1", isMonotonic="true"),
        "histogram": _struct(dataPoints="_records.histogram", aggregationTemporality="1"),
    }
    # one shape for all metrics of an array: the kinds a metric is not are NULL and left out of the JSON
    empty = {k: f"CASE WHEN false THEN {v} END" for k, v in kinds.items()}
    metrics = ", ".join(
        _struct(name=f"'event.{k}'", unit="'cents'", **{**empty, k: v}) for k, v in kinds.items()
    )
    resource = _attrs(_kv("service.name", "stringValue", "svc"))
    names = ("resourceMetrics", "scopeMetrics", "metrics")
    lines = _lines(rows, record, resource, names, ["svc"], damaged, f"array({metrics})")
    return _write(lines, path, files, _EVENTS_PER_BATCH, compression)
