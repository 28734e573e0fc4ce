"""Registered queries: every operator on whole inputs derived from the given tables.

Results hold only scalars (text, numbers, dates as text), so that they can be
compared with SQL.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from datetime import date, datetime, timedelta
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from signalbarn.functions.columns import attr, has_attr_key, has_attr_value, promoted_name
from signalbarn.functions.jobs import run_together
from signalbarn.operators import histograms as H
from signalbarn.operators import logs as L
from signalbarn.operators import metrics as M
from signalbarn.operators import rows as R
from signalbarn.operators import traces as T
from signalbarn.plans import inputs, wire
from signalbarn.schemas import METRIC_TABLES, TABLES
from signalbarn.session import configure, scratch_dir
from signalbarn.sources import batches as B
from signalbarn.sources import tables as S
from signalbarn.sources.ingest import ingest
from signalbarn.streaming.ingest import (
    stream_ingest,
    stream_route_metrics,
    stream_trace_lookup,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Parameters shared with the SQL counterparts.
TRACE_NUMBER = 7
TOKEN = "137"
SPAN_NUMBER = 37
SLA_NANOS = 100_000_000
NOW = datetime(2024, 1, 28, 12, 0, 0)
TTL = timedelta(days=20)
CLOSED_BEFORE = date(2024, 1, 20)


def named(name: str) -> Callable[[Query], Query]:
    """Register a query, with the result settings applied when it runs."""

    def register(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(configure(spark), sf_dir)

        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        return fn

    return register


def query(fn: Query) -> Query:
    return named(fn.__name__)(fn)


def _hash_id(prefix: str, number: int, length: int = 32) -> str:
    return hashlib.md5(f"{prefix}{number}".encode()).hexdigest()[:length]


TRACE_ID = _hash_id("t", TRACE_NUMBER)
SPAN_ID = _hash_id("s", SPAN_NUMBER, 16)


def _day(c: str = "EventDate") -> Column:
    return F.col(c).cast("string").alias(c)


def _joined(c: str, name: str) -> Column:
    """Number array as text."""
    return F.array_join(F.transform(c, lambda x: x.cast("bigint").cast("string")), ",").alias(name)


# ---------------------------------------------------------------- projections of rows

LOG_COLUMNS = [
    "TraceId",
    "SpanId",
    "TimestampNanos",
    "ObservedTimestampNanos",
    "SeverityText",
    "SeverityNumber",
    "ServiceName",
    "ServiceVersion",
    "Body",
]


def _log_view(logs: DataFrame) -> DataFrame:
    return logs.select(
        *LOG_COLUMNS,
        attr("LogAttributes", "event_type").alias("event_type"),
        attr("LogAttributes", "k").alias("k"),
        attr("ResourceAttributes", "service.name").alias("resource_service"),
    )


def _span_view(spans: DataFrame) -> DataFrame:
    event, link = F.get("Events", F.lit(0)), F.get("Links", F.lit(0))
    return spans.select(
        "TraceId",
        "SpanId",
        "ParentSpanId",
        "SpanName",
        "SpanKind",
        "ServiceName",
        "TimestampNanos",
        "Duration",
        "StatusCode",
        attr("SpanAttributes", "k").alias("k"),
        F.coalesce(event["Name"], F.lit("")).alias("event_name"),
        attr(event["Attributes"], "exception.type").alias("exception_type"),
        F.coalesce(link["TraceId"], F.lit("")).alias("link_trace"),
        F.coalesce(link["SpanId"], F.lit("")).alias("link_span"),
    )


def _text(*parts: Column | str) -> Column:
    """Numbers as text, joined by commas."""
    return F.concat_ws(",", *[F.col(p) if isinstance(p, str) else p.cast("string") for p in parts])


def _whole(c: Column) -> Column:
    return c.cast("bigint")


def _of_quantile(q: float) -> Column:
    values = F.filter("ValueAtQuantiles", lambda v: v["Quantile"] == F.lit(q))
    return _whole(F.sum(F.try_element_at(values, F.lit(1))["Value"]))


def _nested(table: str) -> Column:
    """What tells whether the nested parts of a table's points came through."""
    if table == "gauge":
        return _text(
            _whole(F.sum(F.size("Exemplars"))),
            _whole(F.sum(F.aggregate("Exemplars", F.lit(0.0), lambda n, x: n + x["Value"]))),
            F.count_if(F.get("Exemplars", F.lit(0))["SpanId"] != ""),
        )
    if table == "sum":
        return _text(F.count_if("IsMonotonic"), F.max("AggregationTemporality"))
    if table == "histogram":
        return _text(
            *[F.sum(F.get("BucketCounts", F.lit(i))) for i in range(len(inputs.BOUNDS) + 1)],
            _whole(F.sum(F.aggregate("ExplicitBounds", F.lit(0.0), lambda n, x: n + x))),
        )
    if table == "exponential_histogram":
        return _text(
            F.sum("PositiveOffset"),
            F.sum(F.size("PositiveBucketCounts")),
            F.sum(F.aggregate("PositiveBucketCounts", F.lit(0).cast("bigint"), lambda n, x: n + x)),
            F.sum(F.size("NegativeBucketCounts")),
        )
    return _text(*[_of_quantile(q) for q in (0.5, 0.9, 0.99)])


def _metric_view(tables: dict[str, DataFrame]) -> DataFrame:
    """Points, totals and nested parts per table and service."""
    out = None
    for table, df in tables.items():
        measure = "Value" if table in ("gauge", "sum") else "Sum"
        one = df.groupBy("ServiceName").agg(
            F.count(F.lit(1)).alias("points"),
            F.sum(measure).cast("bigint").alias("total"),
            F.count_distinct("SeriesKey").alias("series"),
            _nested(table).alias("nested"),
        )
        one = one.select(F.lit(table).alias("table_name"), "*")
        out = one if out is None else out.unionByName(one)
    return out


# ---------------------------------------------------------------- sources and sinks


@query
def otlp_logs(spark, sf_dir):
    path = wire.write_log_batches(spark, sf_dir, scratch_dir(spark, "otlp-logs"))
    return _log_view(R.to_logs_rows(B.read_otlp_logs(spark, path)))


@query
def otlp_traces(spark, sf_dir):
    path = wire.write_span_batches(spark, sf_dir, scratch_dir(spark, "otlp-traces"))
    return _span_view(R.to_span_rows(B.read_otlp_traces(spark, path)))


@query
def otlp_metrics(spark, sf_dir):
    path = wire.write_metric_batches(spark, sf_dir, scratch_dir(spark, "otlp-metrics"))
    return _metric_view(R.route_metrics(B.read_otlp_metrics(spark, path)))


_BATCH_WRITERS = {
    "logs": wire.write_log_batches,
    "traces": wire.write_span_batches,
    "metrics": wire.write_mixed_metric_batches,
}
#: A measure of each table that tells its rows from others.
_MEASURES = {"logs": "SeverityNumber", "traces": "Duration", "gauge": "Value", "sum": "Value", "histogram": "Sum"}


@query
def ingest_rejects(spark, sf_dir):
    """Damaged batches of all signals, ingested once: what was stored and what was rejected, counted from the files."""
    done = {}

    def store(signal: str) -> None:
        source = _BATCH_WRITERS[signal](spark, sf_dir, scratch_dir(spark, f"damaged-{signal}"), damaged=True)
        target = scratch_dir(spark, f"ingested-{signal}")
        done[signal] = target, ingest(spark, signal, source, target)

    # one signal's last tasks leave cores to the others
    run_together(spark, [partial(store, signal) for signal in _BATCH_WRITERS])
    out = None
    for signal in _BATCH_WRITERS:
        target, counts = done[signal]
        parts = [
            S.read_table(spark, table, S.metric_path(target, table)).agg(
                F.lit(outcome).alias("outcome"),
                F.lit(table).alias("table_name"),
                F.count(F.lit(1)).alias("records"),
                F.sum(_MEASURES[table]).cast("bigint").alias("total"),
            )
            for outcome, table in sorted(counts)
            if outcome == R.ROW
        ]
        rejects = S.read_rejects(spark, f"{target}/rejects")
        parts.append(
            rejects.groupBy(F.col("Level").alias("outcome")).agg(
                F.lit("none").alias("table_name"),
                F.count(F.lit(1)).alias("records"),
                F.count("Raw").alias("total"),
            )
        )
        for part in parts:
            one = part.select(F.lit(signal).alias("signal"), "*")
            out = one if out is None else out.unionByName(one)
    return out


def _stored(spark, sf_dir, table: str, label: str) -> str:
    path = scratch_dir(spark, label)
    rows = {
        "logs": inputs.logs,
        "traces": inputs.spans,
    }[table](spark, sf_dir)
    S.write_table(rows, table, path)
    return path


@query
def scan_day_range(spark, sf_dir):
    path = _stored(spark, sf_dir, "traces", "scan")
    found = S.scan(
        spark, "traces", path, datetime(2024, 1, 10, 6), datetime(2024, 1, 12, 18)
    )
    return found.select("TraceId", "SpanId", "TimestampNanos", _day())


@query
def roundtrip_logs(spark, sf_dir):
    path = _stored(spark, sf_dir, "logs", "roundtrip-logs")
    return _log_view(S.read_table(spark, "logs", path))


@query
def roundtrip_traces(spark, sf_dir):
    path = _stored(spark, sf_dir, "traces", "roundtrip-traces")
    return _span_view(S.read_table(spark, "traces", path))


@query
def route_metrics(spark, sf_dir):
    path = wire.write_metric_batches(spark, sf_dir, scratch_dir(spark, "route-in"))
    root = scratch_dir(spark, "route-out")
    S.write_metrics(B.read_otlp_metrics(spark, path), root)
    return _metric_view(
        {t: S.read_table(spark, t, S.metric_path(root, t)) for t in METRIC_TABLES}
    )


def _lookup_view(lookup: DataFrame) -> DataFrame:
    return lookup.select(
        "TraceId",
        F.unix_seconds("Start").alias("start_s"),
        F.unix_seconds("End").alias("end_s"),
    )


@query
def roundtrip_lookup(spark, sf_dir):
    path = scratch_dir(spark, "lookup")
    S.write_trace_lookup(T.trace_id_ts(inputs.spans(spark, sf_dir)), path)
    return _lookup_view(S.read_table(spark, "lookup", path))


def _database(spark, label: str) -> tuple[str, dict[str, str]]:
    """A new database in the shared folder and the catalog names of its tables."""
    folder = scratch_dir(spark, label)
    database = "signals_" + folder.rsplit("-", 1)[1]
    S.ensure_tables(spark, database, folder)
    names = S.ensure_tables(spark, database, folder)  # a second call changes nothing
    return database, dict(zip(TABLES, names))


@query
def ensure_tables(spark, sf_dir):
    database, names = _database(spark, "db")
    spans = inputs.spans(spark, sf_dir)
    filled = {
        "logs": inputs.logs(spark, sf_dir),
        "traces": spans,
        "lookup": T.trace_id_ts(spans),
        "gauge": inputs.gauge(spark, sf_dir),
        "sum": inputs.sum_delta(spark, sf_dir),
        "histogram": inputs.histogram(spark, sf_dir),
        "exponential_histogram": inputs.exp_histogram(spark, sf_dir),
        "summary": inputs.summary(spark, sf_dir),
    }
    out = None
    for table, rows in filled.items():
        S.insert_rows(rows, table, names[table])
        day = TABLES[table].day
        one = spark.table(names[table]).agg(
            F.count(F.lit(1)).alias("rows_stored"), F.count_distinct(day).alias("days")
        )
        one = one.select(F.lit(TABLES[table].name).alias("table_name"), "*")
        out = one if out is None else out.unionByName(one)
    counts = scratch_dir(spark, "db-counts")
    out.write.parquet(counts)
    spark.sql(f"DROP DATABASE `{database}` CASCADE")
    return spark.read.schema(out.schema).parquet(counts)


# ---------------------------------------------------------------- projections


@query
def log_detail(spark, sf_dir):
    return R.log_detail(inputs.logs(spark, sf_dir))


@query
def span_detail(spark, sf_dir):
    path = wire.write_span_batches(spark, sf_dir, scratch_dir(spark, "span-detail"))
    return R.span_detail(B.read_otlp_traces(spark, path))


@query
def metric_detail(spark, sf_dir):
    path = wire.write_metric_batches(spark, sf_dir, scratch_dir(spark, "metric-detail"))
    return (
        R.metric_detail(B.read_otlp_metrics(spark, path))
        .groupBy("name", "description", "unit", "type")
        .agg(F.count(F.lit(1)).alias("metrics"))
    )


@query
def attrs_to_map(spark, sf_dir):
    path = wire.write_log_batches(spark, sf_dir, scratch_dir(spark, "attrs"))
    logs = R.to_logs_rows(B.read_otlp_logs(spark, path))
    return logs.select(
        "TimestampNanos",
        attr("LogAttributes", "event_type").alias("event_type"),
        attr("LogAttributes", "k").alias("k"),
        attr("LogAttributes", "bare").alias("bare"),
        attr("LogAttributes", "missing").alias("missing"),
        F.size("LogAttributes").alias("keys"),
    )


@query
def promote_service(spark, sf_dir):
    bare = inputs.logs(spark, sf_dir).drop("ServiceName", "ServiceVersion")
    return R.promote_service(bare).select("TimestampNanos", "ServiceName", "ServiceVersion")


@query
def span_events(spark, sf_dir):
    return T.explode_span_events(inputs.spans(spark, sf_dir)).select(
        "TraceId",
        "SpanId",
        "SpanName",
        "EventTimestampNanos",
        "EventName",
        attr("EventAttributes", "exception.type").alias("exception_type"),
    )


@query
def span_links(spark, sf_dir):
    return T.explode_span_links(inputs.spans(spark, sf_dir)).select(
        "TraceId", "SpanId", "LinkTraceId", "LinkSpanId"
    )


@query
def exemplars(spark, sf_dir):
    return M.explode_exemplars(inputs.gauge(spark, sf_dir)).select(
        "ServiceName",
        "TimeUnixNanos",
        "TraceId",
        "SpanId",
        F.col("ExemplarValue").cast("bigint").alias("value"),
        attr("ExemplarAttributes", "k").alias("k"),
    )


@query
def exemplars_all_types(spark, sf_dir):
    """Exemplars of gauges, sums and both kinds of histograms."""
    out = None
    for table, points in inputs.with_exemplars(spark, sf_dir).items():
        one = M.explode_exemplars(points).select(
            F.lit(table).alias("table_name"),
            "ServiceName",
            "TimeUnixNanos",
            "ExemplarTimeNanos",
            "TraceId",
            "SpanId",
            F.col("ExemplarValue").cast("bigint").alias("value"),
            attr("ExemplarAttributes", "k").alias("k"),
        )
        out = one if out is None else out.unionByName(one)
    return out


@query
def summary_quantiles(spark, sf_dir):
    return M.explode_quantiles(inputs.summary(spark, sf_dir)).select(
        "ServiceName",
        "TimeUnixNanos",
        "Count",
        F.col("Sum").cast("bigint").alias("total"),
        "Quantile",
        F.col("QuantileValue").cast("bigint").alias("value"),
    )


@query
def nested_arrays(spark, sf_dir):
    spans = inputs.spans(spark, sf_dir).select("SpanId", "Events", "Links")
    flat = T.nested_to_arrays(T.nested_to_arrays(spans, "Events"), "Links")
    flat = flat.withColumn("event_names", F.array_join(F.col("`Events.Name`"), ","))
    back = T.arrays_to_nested(T.arrays_to_nested(flat, "Events"), "Links")
    return back.select(
        "SpanId",
        "event_names",
        F.size("Events").alias("events"),
        F.size("Links").alias("links"),
        F.coalesce(F.get("Events", F.lit(0))["TimestampNanos"], F.lit(0)).alias("event_nanos"),
        F.coalesce(F.get("Links", F.lit(0))["SpanId"], F.lit("")).alias("link_span"),
    )


@query
def collection_lag(spark, sf_dir):
    return L.collection_lag(inputs.logs(spark, sf_dir)).select("TimestampNanos", "LagNanos")


# ---------------------------------------------------------------- filters


@query
def nonempty_trace(spark, sf_dir):
    return T.nonempty_trace(inputs.logs(spark, sf_dir)).select("TraceId", "TimestampNanos")


@query
def by_trace_id(spark, sf_dir):
    spans = T.by_trace_id(inputs.spans(spark, sf_dir), TRACE_ID)
    logs = T.by_trace_id(inputs.logs(spark, sf_dir), TRACE_ID)
    return spans.select(F.lit("span").alias("signal"), "TraceId", "SpanId").unionByName(
        logs.select(F.lit("log").alias("signal"), "TraceId", "SpanId")
    )


@query
def by_span_id(spark, sf_dir):
    return L.by_span_id(inputs.logs(spark, sf_dir), SPAN_ID).select(*LOG_COLUMNS)


@named("has_attr_key")
def has_attr_key_query(spark, sf_dir):
    logs, spans = inputs.logs(spark, sf_dir), inputs.spans(spark, sf_dir)
    events = T.explode_span_events(spans)
    found = T.where_attr_key(events, "EventAttributes", "exception.type")
    flags = logs.select(
        has_attr_key("LogAttributes", "k").alias("has_k"),
        has_attr_key("LogAttributes", "absent").alias("has_absent"),
    )
    return (
        flags.groupBy("has_k", "has_absent")
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.lit("logs").alias("source"), "has_k", "has_absent", "n")
        .unionByName(
            found.agg(F.count(F.lit(1)).alias("n")).select(
                F.lit("events").alias("source"),
                F.lit(True).alias("has_k"),
                F.lit(False).alias("has_absent"),
                "n",
            )
        )
    )


@named("has_attr_value")
def has_attr_value_query(spark, sf_dir):
    logs = inputs.logs(spark, sf_dir).filter(has_attr_value("LogAttributes", "42"))
    return logs.select("TimestampNanos", "ServiceName", attr("LogAttributes", "k").alias("k"))


@query
def attr_equals(spark, sf_dir):
    found = T.where_attr_equals(
        inputs.logs(spark, sf_dir), "ResourceAttributes", "service.name", "svc-3"
    )
    return found.select("TimestampNanos", "ServiceName", "Body")


@query
def promoted_attr(spark, sf_dir):
    """A dotted key of one map and a key of another, promoted for half of the files, read back and filtered."""
    keys = {"ResourceAttributes": ["service.name"], "LogAttributes": ["k", "service.name"]}
    rows = inputs.logs(spark, sf_dir)
    older = F.col("TimestampNanos") % 2 == 0
    path = scratch_dir(spark, "promoted")
    S.write_table(rows.filter(older), "logs", path)
    S.write_table(S.with_promoted(rows.filter(~older), keys), "logs", path)
    stored = S.scan(spark, "logs", path, datetime(2024, 1, 5), datetime(2024, 1, 20), promoted=keys)
    found = T.where_attr_equals(stored, "ResourceAttributes", "service.name", "svc-3")
    absent = T.where_attr_equals(found, "LogAttributes", "service.name", "")
    promoted = F.col(promoted_name("LogAttributes", "k"))
    return absent.select("TimestampNanos", "ServiceName", F.coalesce(promoted, attr("LogAttributes", "k")).alias("k"))


@query
def duration_between(spark, sf_dir):
    found = T.duration_between(inputs.spans(spark, sf_dir), 10_000_000, 20_000_000)
    return found.select("SpanId", "Duration")


@query
def severity_at_least(spark, sf_dir):
    return L.severity_at_least(inputs.logs(spark, sf_dir), 13).select(
        "TimestampNanos", "SeverityNumber", "SeverityText"
    )


@query
def logs_for(spark, sf_dir):
    found = L.logs_for(
        inputs.logs(spark, sf_dir),
        "svc-2",
        9,
        datetime(2024, 1, 5),
        datetime(2024, 1, 20),
    )
    return found.select(*LOG_COLUMNS)


@query
def series_for(spark, sf_dir):
    found = M.series_for(
        inputs.gauge(spark, sf_dir),
        "svc-1",
        "event.value",
        {"event_type": "purchase"},
        datetime(2024, 1, 5),
        datetime(2024, 1, 20),
    )
    return found.select(
        "ServiceName", "TimeUnixNanos", F.col("Value").cast("bigint").alias("value")
    )


@query
def spans_for(spark, sf_dir):
    found = T.spans_for(
        inputs.spans(spark, sf_dir),
        "svc-4",
        "click",
        datetime(2024, 1, 5),
        datetime(2024, 1, 20),
    )
    return found.select("TraceId", "SpanId", "TimestampNanos")


@query
def body_has_token(spark, sf_dir):
    found = L.body_has_token(inputs.log_text(spark, sf_dir), "thatin")
    return found.select("doc_id", "ServiceName", "TimestampNanos")


@query
def error_spans(spark, sf_dir):
    return T.error_spans(inputs.spans(spark, sf_dir)).select("TraceId", "SpanId", "StatusCode")


@query
def token_days(spark, sf_dir):
    """A body search that reads only the days on which the token lookup has seen the token."""
    path, lookup = _stored(spark, sf_dir, "logs", "tokens-logs"), scratch_dir(spark, "tokens-lookup")
    stored = S.read_table(spark, "logs", path)
    S.write_lookup(L.token_days(stored), "token_days", lookup)
    found = L.search_bodies(stored, S.read_table(spark, "token_days", lookup), TOKEN)
    return found.select("TimestampNanos", "ServiceName", "Body", _day())


# ---------------------------------------------------------------- joins


def _fetched(spark, sf_dir) -> DataFrame:
    """Spans and lookup stored, then one trace fetched through the lookup."""
    spans_path = _stored(spark, sf_dir, "traces", "fetch-spans")
    lookup_path = scratch_dir(spark, "fetch-lookup")
    stored = S.read_table(spark, "traces", spans_path)
    S.write_trace_lookup(T.trace_id_ts(stored), lookup_path)
    lookup = S.read_table(spark, "lookup", lookup_path)
    return T.fetch_trace(stored, lookup, TRACE_ID)


@query
def fetch_trace(spark, sf_dir):
    return _span_view(_fetched(spark, sf_dir))


@query
def logs_spans_inner(spark, sf_dir):
    joined = L.logs_with_spans(inputs.logs(spark, sf_dir), inputs.spans(spark, sf_dir))
    return joined.select("TraceId", "SpanId", "Body", "SpanName", "SpanService", "Duration")


@query
def logs_spans_left(spark, sf_dir):
    joined = L.logs_with_spans(inputs.logs(spark, sf_dir), inputs.spans(spark, sf_dir), "left")
    return joined.select("TraceId", "SpanId", "Body", "SpanName", "SpanService", "Duration")


@query
def logs_spans_semi(spark, sf_dir):
    errors = T.error_spans(inputs.spans(spark, sf_dir))
    return L.logs_with_spans(inputs.logs(spark, sf_dir), errors, "semi").select(
        "TraceId", "SpanId", "Body"
    )


@query
def logs_spans_anti(spark, sf_dir):
    errors = T.error_spans(inputs.spans(spark, sf_dir))
    return L.logs_with_spans(inputs.logs(spark, sf_dir), errors, "anti").select(
        "TraceId", "SpanId", "Body"
    )


@query
def exemplar_spans(spark, sf_dir):
    joined = M.exemplars_to_spans(inputs.gauge(spark, sf_dir), inputs.spans(spark, sf_dir))
    return joined.select(
        "TraceId",
        "SpanId",
        F.col("ExemplarValue").cast("bigint").alias("value"),
        "SpanName",
        "SpanService",
        "Duration",
    )


@query
def link_targets(spark, sf_dir):
    return T.links_to_spans(inputs.spans(spark, sf_dir)).select(
        "TraceId", "SpanId", "LinkTraceId", "LinkSpanId", "TargetService", "TargetName",
        "TargetTimestampNanos",
    )


@query
def parent_child(spark, sf_dir):
    return T.parent_child(inputs.spans(spark, sf_dir)).select(
        "TraceId", "SpanId", "ServiceName", "SpanName", "ParentService", "ParentName"
    )


@query
def service_edges(spark, sf_dir):
    return T.service_edges(inputs.spans(spark, sf_dir))


# ---------------------------------------------------------------- aggregates


@query
def trace_id_ts(spark, sf_dir):
    return _lookup_view(T.trace_id_ts(inputs.spans(spark, sf_dir)))


@query
def batch_summary(spark, sf_dir):
    out = None
    for signal, write in (
        ("logs", wire.write_log_batches),
        ("traces", wire.write_span_batches),
        ("metrics", wire.write_metric_batches),
    ):
        path = write(spark, sf_dir, scratch_dir(spark, f"summary-{signal}"))
        one = B.batch_summary(B.read_batches(spark, signal, path), signal)
        one = one.select(F.lit(signal).alias("signal"), "*")
        out = one if out is None else out.unionByName(one)
    return out.groupBy("signal", "resource_count", "record_count").agg(
        F.count(F.lit(1)).alias("batches")
    )


@query
def dist_mean(spark, sf_dir):
    means = M.mean_from_sum_count(inputs.histogram(spark, sf_dir), ["ServiceName", "MetricName"])
    return means.select("ServiceName", "MetricName", F.round("mean", 4).alias("mean"))


@query
def merge_histograms(spark, sf_dir):
    merged = H.merge_histograms(inputs.histogram(spark, sf_dir), ["ServiceName"])
    return merged.select(
        "ServiceName",
        "Count",
        F.col("Sum").cast("bigint").alias("total"),
        F.col("Min").cast("bigint").alias("low"),
        F.col("Max").cast("bigint").alias("high"),
        _joined("BucketCounts", "buckets"),
        _joined("ExplicitBounds", "bounds"),
    )


def _merged(merged):
    return merged.select(
        "ServiceName",
        "Count",
        F.col("Sum").cast("bigint").alias("total"),
        _joined("BucketCounts", "buckets"),
        _joined("ExplicitBounds", "bounds"),
    )


@query
def merge_histograms_cumulative(spark, sf_dir):
    """Running totals of a series hold its events once, however many points tell them."""
    return _merged(H.merge_histograms(inputs.histogram_cumulative(spark, sf_dir), ["ServiceName"]))


@query
def dist_mean_cumulative(spark, sf_dir):
    points = inputs.histogram_cumulative(spark, sf_dir)
    means = M.mean_from_sum_count(points, ["ServiceName", "MetricName"])
    return means.select("ServiceName", "MetricName", F.round("mean", 4).alias("mean"))


@query
def histogram_quantile(spark, sf_dir):
    found = H.histogram_quantile(inputs.histogram(spark, sf_dir), 0.9)
    return found.select(
        "ServiceName",
        attr("Attributes", "event_type").alias("event_type"),
        "TimeUnixNanos",
        F.round("Quantile", 4).alias("p90"),
    )


@query
def exp_buckets(spark, sf_dir):
    return H.exp_histogram_buckets(
        inputs.exp_histogram(spark, sf_dir), ["ServiceName", "TimeUnixNanos"]
    )


@query
def merge_exp_histograms(spark, sf_dir):
    merged = H.merge_exp_histograms(
        inputs.exp_histogram(spark, sf_dir, mixed_scales=True), ["ServiceName"]
    )
    return merged.select(
        "ServiceName",
        "Scale",
        "Count",
        F.col("Sum").cast("bigint").alias("total"),
        F.col("Min").cast("bigint").alias("low"),
        F.col("Max").cast("bigint").alias("high"),
        "PositiveOffset",
        _joined("PositiveBucketCounts", "buckets"),
    )


@query
def merge_exp_cumulative(spark, sf_dir):
    merged = H.merge_exp_histograms(inputs.exp_histogram_cumulative(spark, sf_dir), ["ServiceName"])
    return merged.select(
        "ServiceName",
        "Scale",
        "Count",
        F.col("Sum").cast("bigint").alias("total"),
        "PositiveOffset",
        _joined("PositiveBucketCounts", "buckets"),
    )


@query
def exp_quantile(spark, sf_dir):
    found = H.exp_histogram_quantile(inputs.exp_histogram(spark, sf_dir), 0.9)
    return found.select("ServiceName", "TimeUnixNanos", F.round("Quantile", 6).alias("p90"))


@query
def logs_by_severity(spark, sf_dir):
    return L.count_by(inputs.logs(spark, sf_dir))


@query
def operation_stats(spark, sf_dir):
    stats = T.operation_stats(inputs.spans(spark, sf_dir), SLA_NANOS)
    return stats.withColumns(
        {
            "avg_duration": F.round("avg_duration", 2),
            "over_sla_share": F.round("over_sla_share", 6),
        }
    )


@query
def trace_stats(spark, sf_dir):
    return T.trace_stats(inputs.spans(spark, sf_dir))


@query
def series_cardinality(spark, sf_dir):
    return M.series_cardinality(inputs.gauge(spark, sf_dir))


@query
def series_sketch(spark, sf_dir):
    """Stored daily sketches merged over all days, and over one half of them, against exact counts."""
    points = inputs.user_gauge(spark, sf_dir)
    path = scratch_dir(spark, "sketches")
    M.series_sketches(points).write.partitionBy("EventDate").parquet(path)
    stored = spark.read.schema("ServiceName STRING, MetricName STRING, Sketch BINARY, EventDate DATE").parquet(path)
    out = None
    for days, cond in (("all", F.lit(True)), ("early", F.col("EventDate") < F.lit(date(2024, 1, 16)))):
        merged = M.series_of_sketches(stored.filter(cond), ["ServiceName"])
        rebuilt = M.series_of_sketches(
            M.series_sketches(points.filter(cond).withColumn("EventDate", F.lit(date(2024, 1, 1)))), ["ServiceName"]
        )
        exact = M.series_cardinality(points.filter(cond)).select("ServiceName", F.col("series").alias("exact"))
        one = (
            exact.join(merged, "ServiceName")
            .join(rebuilt.withColumnRenamed("series", "rebuilt"), "ServiceName")
            .select(
                F.lit(days).alias("days"),
                "ServiceName",
                "exact",
                (F.abs(F.col("series") - F.col("exact")) <= 0.05 * F.col("exact")).alias("is_close"),
                (F.abs(F.col("series") - F.col("rebuilt")) <= 0.02 * F.col("exact")).alias("same_as_rebuilt"),
            )
        )
        out = one if out is None else out.unionByName(one)
    return out


@query
def metric_trend(spark, sf_dir):
    trend = M.metric_trend(inputs.gauge(spark, sf_dir), timedelta(hours=6))
    return trend.select(
        "ServiceName",
        "SeriesKey",
        "BucketNanos",
        "count",
        F.col("sum").cast("bigint").alias("sum"),
        F.col("min").cast("bigint").alias("min"),
        F.col("max").cast("bigint").alias("max"),
        F.round("avg", 4).alias("avg"),
        F.col("last").cast("bigint").alias("last"),
    )


@query
def summary_sla(spark, sf_dir):
    found = M.summary_at(inputs.summary(spark, sf_dir), 0.99, 20_000.0)
    return found.select(
        "ServiceName",
        "TimeUnixNanos",
        F.col("AtQuantile").cast("bigint").alias("p99"),
        F.col("MeetsSla").alias("meets_sla"),
    )


@query
def sum_total(spark, sf_dir):
    both = inputs.sum_delta(spark, sf_dir).unionByName(inputs.sum_cumulative(spark, sf_dir))
    total = M.sum_total(both, ["ServiceName", "AggregationTemporality"])
    return total.select(
        "ServiceName", "AggregationTemporality", F.col("total").cast("bigint").alias("total")
    )


@query
def sum_total_nonmonotonic(spark, sf_dir):
    total = M.sum_total(inputs.sum_up_and_down(spark, sf_dir), ["ServiceName"])
    return total.select("ServiceName", F.col("total").cast("bigint").alias("total"), "unspecified")


# ---------------------------------------------------------------- series


@query
def counter_gaps(spark, sf_dir):
    """Points without a value are no resets and no points."""
    found = M.counter_increase(inputs.sum_with_gaps(spark, sf_dir))
    return found.select(
        "ServiceName", "TimeUnixNanos", F.col("Increase").cast("bigint").alias("increase")
    )


@query
def counter_increase(spark, sf_dir):
    found = M.counter_increase(inputs.sum_cumulative(spark, sf_dir))
    return found.select(
        "ServiceName", "TimeUnixNanos", F.col("Increase").cast("bigint").alias("increase")
    )


@query
def counter_rate(spark, sf_dir):
    found = M.counter_rate(inputs.sum_cumulative(spark, sf_dir))
    return found.select("ServiceName", "TimeUnixNanos", F.round("Rate", 6).alias("rate"))


@query
def to_cumulative(spark, sf_dir):
    found = M.delta_to_cumulative(inputs.sum_delta(spark, sf_dir))
    return found.select(
        "ServiceName",
        "TimeUnixNanos",
        "StartTimeUnixNanos",
        F.col("Value").cast("bigint").alias("value"),
    )


@query
def to_delta(spark, sf_dir):
    found = M.cumulative_to_delta(inputs.sum_cumulative(spark, sf_dir))
    return found.select(
        "ServiceName", "TimeUnixNanos", F.col("Value").cast("bigint").alias("value")
    )


@query
def latest_gauge(spark, sf_dir):
    found = M.latest_per_series(inputs.gauge(spark, sf_dir))
    return found.select(
        "ServiceName", "SeriesKey", "TimeUnixNanos", F.col("Value").cast("bigint").alias("value")
    )


@query
def histogram_delta(spark, sf_dir):
    found = H.histogram_to_delta(inputs.histogram_cumulative(spark, sf_dir))
    return found.select(
        "ServiceName",
        attr("Attributes", "event_type").alias("event_type"),
        "TimeUnixNanos",
        "Count",
        F.col("Sum").cast("bigint").alias("total"),
        _joined("BucketCounts", "buckets"),
    )


@query
def exp_histogram_delta(spark, sf_dir):
    """Intervals of running histograms with negative and zero buckets, whose scale changes in between."""
    deltas = H.exp_histogram_to_delta(inputs.exp_histogram_signed(spark, sf_dir))
    named = deltas.withColumns({"events": F.col("Count"), "total": F.col("Sum").cast("bigint")})
    return H.exp_histogram_buckets(named, ["ServiceName", "TimeUnixNanos", "events", "total"])


# ---------------------------------------------------------------- sorts and top-k


@query
def trace_timeline(spark, sf_dir):
    return T.trace_timeline(inputs.spans(spark, sf_dir), TRACE_ID).select(
        "TraceId", "SpanId", "SpanName", "TimestampNanos", "OffsetNanos", "Duration"
    )


@query
def slowest_spans(spark, sf_dir):
    spans = inputs.spans(spark, sf_dir)
    per_service = T.slowest_spans(spans, 5, "ServiceName").select(
        F.lit("service").alias("scope"), "ServiceName", "SpanId", "Duration"
    )
    overall = T.slowest_spans(spans, 20).select(
        F.lit("all").alias("scope"), "ServiceName", "SpanId", "Duration"
    )
    return per_service.unionByName(overall)


# ---------------------------------------------------------------- streams and retention


@query
def stream_logs(spark, sf_dir):
    """Into the catalog table, with an attribute promoted on the way."""
    source = wire.write_log_batches(spark, sf_dir, scratch_dir(spark, "stream-logs-in"), compression="none")
    target, state = scratch_dir(spark, "stream-logs-out"), scratch_dir(spark, "stream-logs-state")
    _, names = _database(spark, "stream-db")
    stream_ingest(
        spark, "logs", source, target, state, max_files=4, tables={"logs": names["logs"]}
    ).awaitTermination()
    return _log_view(spark.table(names["logs"]))


@query
def stream_traces(spark, sf_dir):
    source = wire.write_span_batches(spark, sf_dir, scratch_dir(spark, "stream-traces-in"), compression="none")
    target = scratch_dir(spark, "stream-traces-out")
    state = scratch_dir(spark, "stream-traces-state")
    stream_ingest(spark, "traces", source, target, state, max_files=4).awaitTermination()
    return _span_view(S.read_table(spark, "traces", f"{target}/rows"))


@query
def stream_metrics(spark, sf_dir):
    source = wire.write_metric_batches(spark, sf_dir, scratch_dir(spark, "stream-metrics-in"), compression="none")
    root = scratch_dir(spark, "stream-metrics-out")
    state = scratch_dir(spark, "stream-metrics-state")
    stream_route_metrics(spark, source, root, state, max_files=4).awaitTermination()
    return _metric_view(
        {t: S.read_table(spark, t, S.metric_path(root, t)) for t in METRIC_TABLES}
    )


def _streamed_lookup(spark, sf_dir) -> DataFrame:
    spans_path = _stored(spark, sf_dir, "traces", "stream-lookup-in")
    lookup_path = scratch_dir(spark, "stream-lookup-out")
    state = scratch_dir(spark, "stream-lookup-state")
    stream_trace_lookup(spark, spans_path, lookup_path, state, max_files=16).awaitTermination()
    return S.read_table(spark, "lookup", lookup_path)


@named("stream_trace_lookup")
def stream_trace_lookup_query(spark, sf_dir):
    """The traces and time spans the partial rows cover, by the first digit of the id."""
    lookup = _streamed_lookup(spark, sf_dir)
    return lookup.groupBy(F.substring("TraceId", 1, 1).alias("digit")).agg(
        F.count_distinct("TraceId").alias("traces"),
        F.unix_seconds(F.min("Start")).alias("first_s"),
        F.unix_seconds(F.max("End")).alias("last_s"),
    )


@query
def collapse_lookup(spark, sf_dir):
    return _lookup_view(T.collapse_lookup(_streamed_lookup(spark, sf_dir)))


@query
def expire_rows(spark, sf_dir):
    kept = S.expire_rows(inputs.logs(spark, sf_dir), "Timestamp", TTL, NOW)
    return kept.select("TimestampNanos", "ServiceName")


@query
def expired_partitions(spark, sf_dir):
    path = _stored(spark, sf_dir, "traces", "expired")
    days = S.expired_partitions(S.read_table(spark, "traces", path), "traces", TTL, NOW)
    return days.select(_day(), F.unix_micros("LastTime").alias("last_us"))


@query
def merge_days(spark, sf_dir):
    """Days of a catalog table written in several batches, rewritten as one sorted file each and swapped."""
    _, names = _database(spark, "merge-db")
    spans = inputs.spans(spark, sf_dir)
    for part in range(3):
        S.insert_rows(spans.filter(F.crc32(F.col("SpanId").cast("binary")) % 3 == part), "traces", names["traces"])
    merged = S.merge_days(spark, "traces", names["traces"], CLOSED_BEFORE)
    S.drop_replaced(spark, merged)
    closed = F.col("EventDate") < F.lit(CLOSED_BEFORE)
    stored = spark.table(names["traces"]).select(
        _day(), "Duration", "SpanId", F.when(closed, F.input_file_name()).alias("_file")
    )
    files = F.count_distinct("_file")
    return stored.groupBy("EventDate").agg(
        F.count(F.lit(1)).alias("spans"),
        F.sum("Duration").alias("duration"),
        F.count_distinct("SpanId").alias("ids"),
        F.when(files > 0, files).alias("files"),
    )


@query
def drop_expired(spark, sf_dir):
    """What is left of a catalog table after its expired days were dropped."""
    _, names = _database(spark, "drop-db")
    S.insert_rows(inputs.spans(spark, sf_dir), "traces", names["traces"])
    S.drop_expired(spark, "traces", names["traces"], TTL, NOW)
    left = spark.table(names["traces"])
    return left.groupBy(_day()).agg(F.count(F.lit(1)).alias("spans"))


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Store spans and their lookup, fetch one trace through it, lay it out in time."""
    configure(spark)
    return T.trace_timeline(_fetched(spark, sf_dir), TRACE_ID).select(
        "TraceId",
        "SpanId",
        "ParentSpanId",
        "ServiceName",
        "SpanName",
        "TimestampNanos",
        "OffsetNanos",
        "Duration",
        "StatusCode",
    )
