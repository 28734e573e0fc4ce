"""Log operators: search, counts and the join with spans."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalbarn.functions.columns import TOKEN_SEPARATORS, has_token, in_day_range, in_time_range
from signalbarn.operators.keys import id_key, id_key_or_none, with_ids


def by_span_id(logs: DataFrame, span_id: str) -> DataFrame:
    return logs.filter(F.col("SpanId") == span_id)


def severity_at_least(logs: DataFrame, low: int) -> DataFrame:
    return logs.filter(F.col("SeverityNumber") >= low)


def severity_between(logs: DataFrame, low: int, high: int) -> DataFrame:
    return logs.filter(F.col("SeverityNumber").between(low, high))


def logs_for(
    logs: DataFrame,
    service: str,
    severity: int | None = None,
    start: int | datetime | None = None,
    end: int | datetime | None = None,
) -> DataFrame:
    """Logs of one service, from a severity up, in a half-open time range."""
    cond = (F.col("ServiceName") == service) & in_time_range("TimestampNanos", start, end)
    if severity is not None:
        cond = cond & (F.col("SeverityNumber") >= severity)
    if "EventDate" in logs.columns:
        cond = cond & in_day_range("EventDate", start, end)
    return logs.filter(cond)


def body_has_token(logs: DataFrame, token: str) -> DataFrame:
    return logs.filter(has_token("Body", token))


def token_days(logs: DataFrame) -> DataFrame:
    """The distinct tokens of each day's bodies, as (Token, EventDate): a lookup for body searches.

    Like the trace lookup it is maintained batch by batch: every batch may add
    its own rows, and readers count a row once. Tasks first drop their own
    repeats, so a token that every body holds sends one row per task and day.
    """
    tokens = F.array_distinct(F.split("Body", TOKEN_SEPARATORS))
    day = "EventDate" if "EventDate" in logs.columns else F.to_date("Timestamp").alias("EventDate")
    return (
        logs.select(F.explode(tokens).alias("Token"), day).filter(F.col("Token") != "").distinct()
    )


def search_bodies(logs: DataFrame, lookup: DataFrame, token: str) -> DataFrame:
    """`body_has_token` that reads only the days on which the lookup has seen the token.

    The days become an equi-join on the partition column, which prunes the scan
    at run time. They are at most one row per calendar day, so broadcasting them
    is bounded whatever the size of the tables.
    """
    days = lookup.filter(F.col("Token") == token).select("EventDate").distinct()
    return body_has_token(logs, token).join(F.broadcast(days), "EventDate", "left_semi")


def count_by(logs: DataFrame, *columns: str) -> DataFrame:
    """Log counts by service, version and severity (or the columns given)."""
    keys = columns or ("ServiceName", "ServiceVersion", "SeverityText", "SeverityNumber")
    return logs.groupBy(*keys).agg(F.count(F.lit(1)).alias("logs"))


def collection_lag(logs: DataFrame) -> DataFrame:
    """Observed minus event time in nanoseconds, as `LagNanos`."""
    return logs.withColumn(
        "LagNanos", F.col("ObservedTimestampNanos") - F.col("TimestampNanos")
    )


def logs_with_spans(logs: DataFrame, spans: DataFrame, how: str = "inner") -> DataFrame:
    """Logs joined with their span on `(TraceId, SpanId)`; empty ids never match.

    `how` is inner, left, semi or anti. Span columns `SpanName`, `SpanKind`,
    `SpanService`, `StatusCode` and `Duration` are added by inner and left.
    """
    how = {"semi": "left_semi", "anti": "left_anti"}.get(how, how)
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"unsupported join type: {how}")
    keep_all = how in ("left", "left_anti")
    right = spans.filter(with_ids()).select(
        F.col("TraceId").alias("_trace"),
        (id_key() if keep_all else F.col("SpanId")).alias("_span"),
        "SpanName",
        "SpanKind",
        F.col("ServiceName").alias("SpanService"),
        "StatusCode",
        "Duration",
    )
    if keep_all:
        left = logs.withColumn("_key", id_key_or_none())
    else:
        left = logs.filter(with_ids()).withColumn("_key", F.col("SpanId"))
    on = (F.col("TraceId") == F.col("_trace")) & (F.col("_key") == F.col("_span"))
    return left.join(right, on, how).drop("_trace", "_span", "_key")
