"""Trace operators: lookup, fetch, tree and graph joins, statistics, top-k."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from signalbarn.functions.columns import (
    attr_equals,
    has_attr_key,
    has_attr_value,
    in_day_range,
    in_time_range,
    nanos_to_second,
    nonempty,
    promoted_name,
)
from signalbarn.functions.quantiles import exact_quantiles
from signalbarn.operators.keys import id_key, id_key_or_none, with_ids

# ---------------------------------------------------------------- filters


def nonempty_trace(df: DataFrame) -> DataFrame:
    return df.filter(F.col("TraceId") != "")


def by_trace_id(df: DataFrame, trace_id: str) -> DataFrame:
    """Equality on the id column itself, so that it reaches the Parquet filters."""
    return df.filter(F.col("TraceId") == trace_id)


def where_attr_key(df: DataFrame, column: str, key: str) -> DataFrame:
    return df.filter(has_attr_key(column, key))


def where_attr_value(df: DataFrame, column: str, value: str) -> DataFrame:
    return df.filter(has_attr_value(column, value))


def where_attr_equals(df: DataFrame, column: str, key: str, value: str) -> DataFrame:
    """Rows whose map `column` has this value; uses the column promoted from that map and key, if any.

    The promoted column is NULL in files written before the promotion, where the
    map decides. Its own test stands alone, so that it reaches the scan.
    """
    promoted = promoted_name(column, key)
    if promoted in df.columns:
        own = F.col(promoted)
        # written with two kinds of equality, since the planner joins equal conditions into one that is not pushed
        return df.filter((own == value) | own.isNull()).filter(
            own.eqNullSafe(value) | attr_equals(column, key, value)
        )
    return df.filter(attr_equals(column, key, value))


def duration_between(spans: DataFrame, low: int, high: int) -> DataFrame:
    """Duration in nanoseconds, both ends included."""
    return spans.filter(F.col("Duration").between(low, high))


def spans_for(
    spans: DataFrame,
    service: str,
    operation: str | None = None,
    start: int | datetime | None = None,
    end: int | datetime | None = None,
) -> DataFrame:
    cond = (F.col("ServiceName") == service) & in_time_range("TimestampNanos", start, end)
    if operation is not None:
        cond = cond & (F.col("SpanName") == operation)
    if "EventDate" in spans.columns:
        cond = cond & in_day_range("EventDate", start, end)
    return spans.filter(cond)


def is_error():
    return F.upper("StatusCode") == "ERROR"


def error_spans(spans: DataFrame) -> DataFrame:
    return spans.filter(is_error())


# ---------------------------------------------------------------- nested columns


def explode_span_events(spans: DataFrame) -> DataFrame:
    """One row per span event."""
    return spans.select(
        "TraceId", "SpanId", "ServiceName", "SpanName", F.explode("Events").alias("e")
    ).select(
        "TraceId",
        "SpanId",
        "ServiceName",
        "SpanName",
        F.col("e.Timestamp").alias("EventTimestamp"),
        F.col("e.TimestampNanos").alias("EventTimestampNanos"),
        F.col("e.Name").alias("EventName"),
        F.col("e.Attributes").alias("EventAttributes"),
    )


def explode_span_links(spans: DataFrame) -> DataFrame:
    """One row per span link."""
    return spans.select(
        "TraceId", "SpanId", "ServiceName", "SpanName", F.explode("Links").alias("x")
    ).select(
        "TraceId",
        "SpanId",
        "ServiceName",
        "SpanName",
        F.col("x.TraceId").alias("LinkTraceId"),
        F.col("x.SpanId").alias("LinkSpanId"),
        F.col("x.TraceState").alias("LinkTraceState"),
        F.col("x.Attributes").alias("LinkAttributes"),
    )


def nested_to_arrays(df: DataFrame, column: str) -> DataFrame:
    """A struct array as parallel arrays named `column.field`."""
    fields = df.schema[column].dataType.elementType.fieldNames()
    kept = [f"`{c}`" for c in df.columns if c != column]
    return df.select(*kept, *[F.col(f"{column}.{f}").alias(f"{column}.{f}") for f in fields])


def arrays_to_nested(df: DataFrame, column: str) -> DataFrame:
    """Parallel arrays named `column.field` back to one struct array."""
    names = [c for c in df.columns if c.startswith(f"{column}.")]
    kept = [f"`{c}`" for c in df.columns if c not in names]
    fields = [c.split(".", 1)[1] for c in names]
    zipped = F.arrays_zip(*[F.col(f"`{c}`").alias(f) for c, f in zip(names, fields)])
    named = F.transform(
        zipped, lambda z: F.struct(*[z[f].alias(f) for f in fields])
    )
    return df.select(*kept, named.alias(column))


# ---------------------------------------------------------------- trace lookup


def trace_id_ts(spans: DataFrame) -> DataFrame:
    """Time range of each trace, truncated to seconds."""
    return (
        nonempty_trace(spans)
        .groupBy("TraceId")
        .agg(F.min("TimestampNanos").alias("_lo"), F.max("TimestampNanos").alias("_hi"))
        .select(
            "TraceId",
            nanos_to_second("_lo").alias("Start"),
            nanos_to_second("_hi").alias("End"),
        )
    )


def collapse_lookup(lookup: DataFrame) -> DataFrame:
    """Partial rows of the lookup, one per written batch, merged per trace."""
    return lookup.groupBy("TraceId").agg(F.min("Start").alias("Start"), F.max("End").alias("End"))


def fetch_trace(spans: DataFrame, lookup: DataFrame, trace_id: str) -> DataFrame:
    """All spans of a trace, reading only the days its lookup range covers.

    `End` is floored to seconds, so the range ends one second after it. The
    days become an equi-join on the partition column, which prunes the scan at
    run time. One collapsed lookup row gives at most one row per calendar day,
    so broadcasting the days is bounded whatever the size of the tables.
    """
    span_range = collapse_lookup(by_trace_id(lookup, trace_id))
    days = span_range.select(
        "TraceId",
        (F.unix_seconds("Start") * 1_000_000_000).alias("_from"),
        ((F.unix_seconds("End") + 1) * 1_000_000_000).alias("_until"),
        F.explode(F.sequence(F.to_date("Start"), F.to_date("End"))).alias("EventDate"),
    )
    return (
        by_trace_id(spans, trace_id)
        .join(F.broadcast(days), ["TraceId", "EventDate"])
        .filter(
            (F.col("TimestampNanos") >= F.col("_from"))
            & (F.col("TimestampNanos") < F.col("_until"))
        )
        .drop("_from", "_until")
    )


def trace_timeline(spans: DataFrame, trace_id: str) -> DataFrame:
    """A trace's spans in time order with their offset from its start.

    The start is one aggregated row, joined back; a window over the trace would
    put the whole of it into one task.
    """
    trace = by_trace_id(spans, trace_id)
    start = trace.groupBy("TraceId").agg(F.min("TimestampNanos").alias("_start"))
    return (
        trace.join(F.broadcast(start), "TraceId")
        .withColumn("OffsetNanos", F.col("TimestampNanos") - F.col("_start"))
        .drop("_start")
        .orderBy("TimestampNanos", "SpanId")
    )


# ---------------------------------------------------------------- joins


def parent_child(spans: DataFrame) -> DataFrame:
    """Each span with the service and name of its parent, NULL where there is none."""
    parents = spans.filter(with_ids()).select(
        F.col("TraceId").alias("_trace"),
        id_key().alias("_span"),
        F.col("ServiceName").alias("ParentService"),
        F.col("SpanName").alias("ParentName"),
    )
    children = spans.withColumn("_key", id_key_or_none(span="ParentSpanId"))
    on = (F.col("TraceId") == F.col("_trace")) & (F.col("_key") == F.col("_span"))
    return children.join(parents, on, "left").drop("_trace", "_span", "_key")


def service_edges(spans: DataFrame) -> DataFrame:
    """Calls from service to service.

    Children are counted per parent before the join, so a parent with very many
    children is one row per child service in it.
    """
    calls = (
        spans.filter(with_ids(span="ParentSpanId"))
        .groupBy("TraceId", F.col("ParentSpanId").alias("SpanId"), "ServiceName")
        .agg(F.count(F.lit(1)).alias("calls"), F.count_if(is_error()).alias("errors"))
        .withColumnRenamed("ServiceName", "callee")
    )
    parents = spans.filter(with_ids()).select(
        "TraceId", "SpanId", F.col("ServiceName").alias("caller")
    )
    return (
        calls.join(parents, ["TraceId", "SpanId"])
        .groupBy("caller", "callee")
        .agg(F.sum("calls").alias("calls"), F.sum("errors").alias("errors"))
    )


def links_to_spans(spans: DataFrame) -> DataFrame:
    """Span links joined with the span they point to, also across traces."""
    links = explode_span_links(spans).filter(with_ids("LinkTraceId", "LinkSpanId"))
    targets = spans.filter(with_ids()).select(
        F.col("TraceId").alias("LinkTraceId"),
        F.col("SpanId").alias("LinkSpanId"),
        F.col("ServiceName").alias("TargetService"),
        F.col("SpanName").alias("TargetName"),
        F.col("TimestampNanos").alias("TargetTimestampNanos"),
    )
    return links.join(targets, ["LinkTraceId", "LinkSpanId"])


# ---------------------------------------------------------------- aggregates


def operation_stats(spans: DataFrame, sla_nanos: int) -> DataFrame:
    """Per service and operation: counts, exact duration percentiles, SLA misses.

    Percentiles are the discrete ones. Counts and coarse ranges come from one
    scan; a second one counts the values of the ranges that hold the ranks.
    """
    one = F.lit(1)
    late = F.col("Duration") > sla_nanos
    total = F.col("Duration").cast("decimal(38,0)")
    extra = {
        "spans": (F.count(one), F.sum("spans")),
        "errors": (F.count_if(is_error()), F.sum("errors")),
        "min_duration": (F.min("Duration"), F.min("min_duration")),
        "max_duration": (F.max("Duration"), F.max("max_duration")),
        "total_duration": (
            F.sum(total).cast("decimal(38,0)"),
            F.sum("total_duration").cast("decimal(38,0)"),
        ),
        "over_sla": (F.count_if(late), F.sum("over_sla")),
    }
    out = exact_quantiles(
        spans,
        ["ServiceName", "SpanName"],
        "Duration",
        {"p50": "0.5", "p95": "0.95", "p99": "0.99"},
        extra,
    )
    return out.select(
        "ServiceName",
        "SpanName",
        "spans",
        "errors",
        "min_duration",
        (F.col("total_duration").cast("double") / F.col("spans")).alias("avg_duration"),
        "max_duration",
        "p50",
        "p95",
        "p99",
        (F.col("over_sla") / F.col("spans")).alias("over_sla_share"),
    )


def trace_stats(spans: DataFrame) -> DataFrame:
    """Per trace: spans, services, errors, first start, last end, wall time, root span.

    Rows are first combined per trace and service; both steps combine on the
    map side. The root is the earliest span without a parent.
    """
    per_service = (
        nonempty_trace(spans)
        .groupBy("TraceId", "ServiceName")
        .agg(
            F.count(F.lit(1)).alias("spans"),
            F.count_if(is_error()).alias("errors"),
            F.min("TimestampNanos").alias("first_start"),
            F.max(F.col("TimestampNanos") + F.col("Duration")).alias("last_end"),
            F.min(
                F.when(
                    ~nonempty("ParentSpanId"),
                    F.struct("TimestampNanos", "SpanId", "SpanName", "ServiceName"),
                )
            ).alias("root"),
        )
    )
    return (
        per_service.groupBy("TraceId")
        .agg(
            F.sum("spans").alias("spans"),
            F.count(F.lit(1)).alias("services"),
            F.sum("errors").alias("errors"),
            F.min("first_start").alias("first_start"),
            F.max("last_end").alias("last_end"),
            F.min("root").alias("root"),
        )
        .select(
            "TraceId",
            "spans",
            "services",
            "errors",
            "first_start",
            "last_end",
            (F.col("last_end") - F.col("first_start")).alias("wall_time"),
            F.col("root.SpanId").alias("root_span_id"),
            F.col("root.SpanName").alias("root_name"),
            F.col("root.ServiceName").alias("root_service"),
        )
    )


def slowest_spans(spans: DataFrame, k: int, by: str | None = None) -> DataFrame:
    """The k longest spans, overall or per value of `by`; ties go to the lower ids."""
    order = [F.desc("Duration"), F.asc("SpanId"), F.asc("TraceId")]
    if by is None:
        return spans.orderBy(*order).limit(k)
    # A first cut per group and hash part keeps a large group off a single task;
    # the k longest of a group are among the k longest of its parts.
    part = F.pmod(F.xxhash64("TraceId", "SpanId"), F.lit(64))
    parts = Window.partitionBy(by, "_part").orderBy(*order)
    whole = Window.partitionBy(by).orderBy(*order)
    return (
        spans.withColumn("_part", part)
        .withColumn("_rank", F.row_number().over(parts))
        .filter(F.col("_rank") <= k)
        .withColumn("Rank", F.row_number().over(whole))
        .filter(F.col("Rank") <= k)
        .drop("_part", "_rank")
    )
