"""Trace and log operators on hand-made rows and skewed joins."""

import hashlib

import pytest
from pyspark.sql import functions as F

from signalbarn.functions import columns as C
from signalbarn.operators import logs as L
from signalbarn.operators import traces as T
from signalbarn.plans import inputs
from tests.conftest import SF_SMALL

SPAN = (
    "TraceId string, SpanId string, ParentSpanId string, ServiceName string, SpanName string, "
    "TimestampNanos bigint, Duration bigint, StatusCode string"
)


def spans(spark, rows):
    return spark.createDataFrame(rows, SPAN).withColumn("SpanKind", F.lit("Internal"))


TREE = [
    ("t1", "a", "", "front", "GET", 100, 50, "Unset"),
    ("t1", "b", "a", "back", "query", 110, 60, "Error"),
    ("t1", "c", "a", "back", "query", 120, 5, "error"),
    ("t2", "a", "", "front", "GET", 500, 9, "Ok"),
    ("t2", "x", "gone", "back", "late", 505, 1, "TIMEOUT"),
    ("", "z", "", "lost", "no trace", 1, 1, "Unset"),
    ("", "y", "z", "lost", "no trace", 2, 1, "Unset"),
]


def test_parent_child(spark):
    out = T.parent_child(spans(spark, TREE))
    got = {(r.TraceId, r.SpanId): r.ParentService for r in out.collect()}
    assert got == {
        ("t1", "a"): None,
        ("t1", "b"): "front",
        ("t1", "c"): "front",
        ("t2", "a"): None,
        ("t2", "x"): None,
        ("", "z"): None,
        ("", "y"): None,
    }


def test_service_edges(spark):
    got = [tuple(r) for r in T.service_edges(spans(spark, TREE)).collect()]
    assert got == [("front", "back", 2, 2)]


def test_trace_stats(spark):
    got = {r.TraceId: r for r in T.trace_stats(spans(spark, TREE)).collect()}
    assert set(got) == {"t1", "t2"}
    t1 = got["t1"]
    assert (t1.spans, t1.services, t1.errors) == (3, 2, 2)
    assert (t1.first_start, t1.last_end, t1.wall_time) == (100, 170, 70)
    assert (t1.root_span_id, t1.root_name, t1.root_service) == ("a", "GET", "front")


def test_operation_stats(spark):
    rows = [("t", str(i), "", "s", "op", i, i, "Error" if i % 4 == 0 else "Ok") for i in range(1, 101)]
    (r,) = T.operation_stats(spans(spark, rows), 90).collect()
    assert (r.spans, r.errors, r.min_duration, r.max_duration) == (100, 25, 1, 100)
    assert (r.p50, r.p95, r.p99) == (50, 95, 99)
    assert r.avg_duration == pytest.approx(50.5)
    assert r.over_sla_share == pytest.approx(0.1)


def test_slowest_spans_in_a_hot_service(spark):
    rows = [("t", f"{i:05}", "", "hot" if i % 10 else "cold", "op", i, i * 7919 % 1009, "Ok") for i in range(5000)]
    df = spans(spark, rows)
    got = {}
    for r in T.slowest_spans(df, 7, "ServiceName").collect():
        got.setdefault(r.ServiceName, []).append((r.Rank, r.Duration, r.SpanId))
    for service, found in got.items():
        mine = sorted((-d, s) for _, s, _, v, _, _, d, _ in rows if v == service)
        assert sorted(found) == [(i + 1, -d, s) for i, (d, s) in enumerate(mine[:7])]
    top = [(r.Duration, r.SpanId) for r in T.slowest_spans(df, 4).collect()]
    assert top == [(-d, s) for d, s in sorted((-r[6], r[1]) for r in rows)[:4]]


def test_collapse_of_partial_rows(spark):
    df = spark.sql(
        "SELECT * FROM VALUES ('t', TIMESTAMP'2024-01-01 10:00:05', TIMESTAMP'2024-01-01 10:00:09'),"
        " ('t', TIMESTAMP'2024-01-01 10:00:01', TIMESTAMP'2024-01-01 10:00:04') AS v(TraceId, Start, End)"
    )
    (r,) = T.collapse_lookup(df).collect()
    assert (r.Start.second, r.End.second) == (1, 9)


def test_fetch_keeps_spans_after_the_floored_end(spark):
    """The lookup's End is floored to seconds; later spans of that second count."""
    rows = inputs.spans(spark, SF_SMALL)
    lookup = T.trace_id_ts(rows)
    for number in (0, 11, 42):
        trace = hashlib.md5(f"t{number}".encode()).hexdigest()
        assert T.fetch_trace(rows, lookup, trace).count() == 5


def test_lookup_leaves_out_empty_ids(spark):
    assert T.trace_id_ts(spans(spark, TREE)).count() == 2


def test_nested_roundtrip(spark):
    rows = inputs.spans(spark, SF_SMALL).select("SpanId", "Events", "Links")
    flat = T.nested_to_arrays(rows, "Events")
    assert "Events.Name" in flat.columns and "Events" not in flat.columns
    back = T.arrays_to_nested(flat, "Events").select("SpanId", "Events", "Links")
    text = [F.to_json(F.struct(*rows.columns)).alias("j")]
    assert rows.select(*text).exceptAll(back.select(*text)).count() == 0


# ---------------------------------------------------------------- logs

LOG = "TraceId string, SpanId string, TimestampNanos bigint, ServiceName string, Body string"


def test_join_types_with_empty_ids(spark):
    logs = spark.createDataFrame(
        [
            ("t1", "a", 1, "s", "hit"),
            ("t1", "q", 2, "s", "miss"),
            ("", "a", 3, "s", "no trace"),
            ("t1", "", 4, "s", "no span"),
            (None, None, 5, "s", "null ids"),
            ("", "", 6, "s", "none"),
        ],
        LOG,
    )
    sp = spans(spark, [*TREE, ("t1", "", "", "odd", "odd", 1, 1, "Ok")])
    bodies = {
        how: sorted(r.Body for r in L.logs_with_spans(logs, sp, how).collect())
        for how in ("inner", "left", "semi", "anti")
    }
    assert bodies["inner"] == bodies["semi"] == ["hit"]
    assert bodies["anti"] == sorted(["miss", "no trace", "no span", "null ids", "none"])
    assert bodies["left"] == sorted([*bodies["anti"], "hit"])
    left = {r.Body: r.SpanService for r in L.logs_with_spans(logs, sp, "left").collect()}
    assert left["hit"] == "front" and left["no span"] is None
    with pytest.raises(ValueError):
        L.logs_with_spans(logs, sp, "cross")


def test_rows_without_ids_spread_over_tasks(spark):
    """Most logs lack ids; in a left join they must not share a partition."""
    logs = spark.range(20000).select(
        F.when(F.col("id") % 3 == 0, "t1").otherwise("").alias("TraceId"),
        F.when(F.col("id") % 3 == 0, F.col("id").cast("string")).otherwise("").alias("SpanId"),
        F.col("id").alias("TimestampNanos"),
        F.lit("s").alias("ServiceName"),
        F.lit("b").alias("Body"),
    )
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = L.logs_with_spans(logs, spans(spark, TREE), "left")
        sizes = [r[1] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert sum(sizes) == 20000
    assert max(sizes) < 2 * 20000 / 8


@pytest.mark.parametrize(
    "body, token, expected",
    [
        ("user=42 ok", "42", True),
        ("user=421 ok", "42", False),
        ("Error at", "error", False),
        ("naïve café", "caf", False),
        ("naïve café", "café", True),
        ("a_b", "a", True),
        ("x\ty", "y", True),
        ("", "a", False),
        ("end", "end", True),
    ],
)
def test_tokens(spark, body, token, expected):
    df = spark.createDataFrame([(body,)], "Body string")
    assert (L.body_has_token(df, token).count() == 1) is expected


def test_token_at_the_end_of_a_long_text(spark):
    df = spark.range(1).select(F.concat(F.repeat(F.lit("word "), 200_000), F.lit("needle")).alias("Body"))
    assert L.body_has_token(df, "needle").count() == 1


def test_severity_ranges(spark):
    df = spark.createDataFrame([(n,) for n in range(1, 25)], "SeverityNumber int")
    assert L.severity_at_least(df, 17).count() == 8
    assert L.severity_between(df, 9, 12).count() == 4


def test_attributes(spark):
    df = spark.sql("SELECT map('a', '1', 'b', '') AS m")
    row = df.select(
        C.attr("m", "a").alias("a"),
        C.attr("m", "zz").alias("zz"),
        C.has_attr_key("m", "b").alias("b"),
        C.has_attr_key("m", "zz").alias("no"),
        C.has_attr_value("m", "1").alias("v"),
        C.attr_equals("m", "zz", "").alias("absent_is_empty"),
        C.hex_id(F.unhex(F.lit("0AFF"))).alias("hex"),
    ).first()
    assert tuple(row) == ("1", "", True, False, True, True, "0aff")


def test_promoted_attribute_is_used(spark):
    from signalbarn.sources.tables import promote_attrs

    df = spark.sql("SELECT map('http.route', '/x') AS SpanAttributes UNION ALL SELECT map('a', 'b')")
    promoted = promote_attrs(df, "SpanAttributes", ["http.route"])
    found = T.where_attr_equals(promoted, "SpanAttributes", "http.route", "/x")
    assert found.count() == 1
    assert T.where_attr_equals(df, "SpanAttributes", "http.route", "/x").count() == 1
