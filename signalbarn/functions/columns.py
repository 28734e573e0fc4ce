"""Scalar column helpers: attributes, times, ids, tokens, enum names."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

NANOS_PER_SECOND = 1_000_000_000

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def text(c: ColumnOrName) -> Column:
    """Absent strings are empty strings in every stored table."""
    return F.coalesce(_col(c), F.lit(""))


# ---------------------------------------------------------------- integers and times


def div(c: ColumnOrName, by: int) -> Column:
    """Exact integer division (Column `/` would go through doubles)."""
    return F.call_function("div", _col(c), F.lit(by).cast("bigint"))


def nanos_to_timestamp(c: ColumnOrName) -> Column:
    return F.timestamp_micros(div(c, 1000))


def nanos_to_second(c: ColumnOrName) -> Column:
    """Timestamp truncated to whole seconds."""
    return F.timestamp_seconds(div(c, NANOS_PER_SECOND))


def to_nanos(value: int | datetime) -> int:
    """A literal bound as epoch nanoseconds; naive datetimes are UTC."""
    if isinstance(value, int):
        return value
    if value.tzinfo is None:
        value = value.replace(tzinfo=timezone.utc)
    delta = value - datetime(1970, 1, 1, tzinfo=timezone.utc)
    return (delta.days * 86_400 + delta.seconds) * NANOS_PER_SECOND + delta.microseconds * 1000


def ttl_seconds(ttl: timedelta) -> int:
    """Whole seconds of a retention time; 0 and less mean no retention."""
    return max(ttl // timedelta(seconds=1), 0)


def ttl_interval(ttl: timedelta) -> Column:
    """Retention as a day-time interval."""
    return F.make_dt_interval(secs=F.lit(ttl_seconds(ttl)).cast("decimal(18,6)"))


def in_time_range(
    nanos: ColumnOrName, start: int | datetime | None, end: int | datetime | None
) -> Column:
    """Half-open range `[start, end)`; an open side is None."""
    cond = F.lit(True)
    if start is not None:
        cond = cond & (_col(nanos) >= F.lit(to_nanos(start)))
    if end is not None:
        cond = cond & (_col(nanos) < F.lit(to_nanos(end)))
    return cond


def in_day_range(
    day: ColumnOrName, start: int | datetime | None, end: int | datetime | None
) -> Column:
    """The days touched by `[start, end)`, as a partition filter."""

    def as_date(nanos: int):
        return (datetime(1970, 1, 1) + timedelta(microseconds=nanos // 1000)).date()

    cond = F.lit(True)
    if start is not None:
        cond = cond & (_col(day) >= F.lit(as_date(to_nanos(start))))
    if end is not None:
        cond = cond & (_col(day) <= F.lit(as_date(to_nanos(end) - 1)))
    return cond


# ---------------------------------------------------------------- attributes


def attr(m: ColumnOrName, key: str) -> Column:
    """Value of an attribute; a missing key reads as the empty string."""
    return F.coalesce(F.try_element_at(_col(m), F.lit(key)), F.lit(""))


def has_attr_key(m: ColumnOrName, key: str) -> Column:
    return F.map_contains_key(_col(m), key)


def has_attr_value(m: ColumnOrName, value: str) -> Column:
    return F.array_contains(F.map_values(_col(m)), value)


def attr_equals(m: ColumnOrName, key: str, value: str) -> Column:
    return attr(m, key) == F.lit(value)


def promoted_name(column: str, key: str) -> str:
    """The top-level column that holds one key of one attribute map.

    All but letters and digits of the key are spelled `_` and their code, so
    that dotted keys need no quoting and no two keys share a column.
    """
    spelled = "".join(c if c.isascii() and c.isalnum() else f"_{ord(c):x}_" for c in key)
    return f"attr_{column}_{spelled}"


def series_key(m: str) -> Column:
    """Order-independent text of an attribute map."""
    return F.expr(sql_series_key(m))


def attrs_to_map(kvs: str) -> Column:
    """Key/value list to a string map; a repeated key keeps its last value."""
    return F.expr(sql_attrs(kvs))


# ---------------------------------------------------------------- SQL text of longer expressions
# The projections of nested batches are written as SQL text: each is one parse
# instead of hundreds of calls into the JVM.


def sql_text(c: str) -> str:
    return f"coalesce({c}, '')"


def sql_long(c: str) -> str:
    """A 64-bit integer that arrives as text; absent reads as 0."""
    return f"coalesce(try_cast({c} AS BIGINT), 0L)"


def sql_bad_long(c: str) -> str:
    """True for text that should be a 64-bit integer and is not one."""
    return f"coalesce(trim({c}) <> '' AND try_cast({c} AS BIGINT) IS NULL, false)"


def sql_timestamp(nanos: str) -> str:
    return f"timestamp_micros(({nanos}) div 1000)"


def sql_series_key(m: str) -> str:
    return f"to_json(map_from_entries(array_sort(map_entries({m}))))"


def sql_double_text(x: str) -> str:
    """Text of a double: plain digits from 1e-6 up to 1e21, exponent form outside."""

    def plain(scale: int) -> str:
        digits = f"CAST(try_cast(CAST({x} AS STRING) AS DECIMAL(38,{scale})) AS STRING)"
        return f"regexp_replace(regexp_replace({digits}, '0+$', ''), '[.]$', '')"

    exponent = (
        f"lower(regexp_replace(regexp_replace(CAST({x} AS STRING), '[.]0E', 'E'), "
        "'E([0-9])', 'E+$1'))"
    )
    return (
        f"CASE WHEN {x} IS NULL THEN NULL "
        f"WHEN isnan({x}) OR abs({x}) = double('Infinity') THEN CAST({x} AS STRING) "
        f"WHEN {x} = 0 THEN '0' "
        f"WHEN abs({x}) >= 1e-3D AND abs({x}) < 1e21D THEN {plain(17)} "
        f"WHEN abs({x}) >= 1e-6D AND abs({x}) < 1e-3D THEN {plain(30)} "
        f"ELSE {exponent} END"
    )


def sql_value(v: str) -> str:
    """Text of one wire value of any kind.

    Bytes stay base64; nested lists and maps become the JSON text of the wire value.
    """

    def kind(name: str, as_type: str = "string") -> str:
        return f"try_variant_get({v}, '$.{name}', '{as_type}')"

    # A one-element array gives the number a name, so that it is read once.
    number = f"try_cast({kind('doubleValue')} AS DOUBLE)"
    number_text = f"transform(array({number}), num -> {sql_double_text('num')})[0]"
    return (
        f"coalesce({kind('stringValue')}, {kind('intValue')}, {number_text}, "
        f"{kind('boolValue')}, {kind('bytesValue')}, "
        f"to_json({kind('arrayValue', 'variant')}), to_json({kind('kvlistValue', 'variant')}), '')"
    )


def sql_attrs(kvs: str) -> str:
    entry = f"named_struct('key', kv.key, 'value', {sql_value('kv.value')})"
    return (
        f"coalesce(map_from_entries(transform(filter({kvs}, kv -> kv.key IS NOT NULL), "
        f"kv -> {entry})), CAST(map() AS MAP<STRING,STRING>))"
    )


def sql_enum(code: str, names: dict[int, str]) -> str:
    """Name of an enum code; an absent code is 0, an unknown one the empty string."""
    cases = " ".join(f"WHEN {k} THEN '{name}'" for k, name in names.items())
    return f"CASE coalesce({code}, 0) {cases} ELSE '' END"


# ---------------------------------------------------------------- ids, tokens, enums


def hex_id(c: ColumnOrName) -> Column:
    """Binary id as lower-case hex text."""
    return F.lower(F.hex(_col(c)))


def nonempty(c: ColumnOrName) -> Column:
    return text(c) != ""


# Fixed value: the ASCII characters that separate body tokens.
TOKEN_SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def has_token(body: ColumnOrName, token: str) -> Column:
    """Whole-token, case-sensitive match over the whole text.

    `contains` is a cheap byte scan that spares most rows the split.
    """
    body = _col(body)
    return F.contains(body, F.lit(token)) & F.array_contains(
        F.split(body, TOKEN_SEPARATORS), token
    )


# Enum names of the data model.
SPAN_KINDS = {0: "Unspecified", 1: "Internal", 2: "Server", 3: "Client", 4: "Producer", 5: "Consumer"}
STATUS_CODES = {0: "Unset", 1: "Ok", 2: "Error"}
