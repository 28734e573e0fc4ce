"""Join keys on trace and span ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def with_ids(trace: str = "TraceId", span: str = "SpanId") -> Column:
    """Both ids are there. Plain comparisons, so that they reach the Parquet scan."""
    return (F.col(trace) != "") & (F.col(span) != "")


def id_key(span: str = "SpanId") -> Column:
    """Join key of a row that is known to have ids."""
    return F.concat(F.lit("s"), F.col(span))


def id_key_or_none(trace: str = "TraceId", span: str = "SpanId") -> Column:
    """Join key of a row that may lack ids; without them it matches nothing.

    In a left or anti join, rows without ids must be kept although they cannot
    match. With their empty ids as the key they would all meet in one task, so
    they get a hash of their other fields instead. The leading letter keeps the
    two kinds of key apart.
    """
    other = F.xxhash64("TimestampNanos", "ServiceName", trace, span)
    return F.when(with_ids(trace, span), id_key(span)).otherwise(
        F.concat(F.lit("x"), other.cast("string"))
    )

