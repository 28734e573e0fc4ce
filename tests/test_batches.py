"""Nested batches: flattening, value kinds, rejects, counts."""

import json
import os
import threading

import pytest
from pyspark.sql import functions as F

from signalbarn.operators import rows as R
from signalbarn.plans import inputs, queries, wire
from signalbarn.sources import batches as B
from signalbarn.sources import tables as S

from .conftest import plan_text

TRACE, SPAN = "0af7651916cd43dd8448eb211c80319c", "b7ad6b7169203331"
BIG = str(2**63 + 5)


def write(path, *batches):
    with open(path, "w") as f:
        for b in batches:
            f.write((b if isinstance(b, str) else json.dumps(b)) + "\n")
    return str(path)


def kv(key, **value):
    return {"key": key, "value": value}


def log_batch(records, resource=()):
    return {
        "resourceLogs": [
            {
                "resource": {"attributes": list(resource)},
                "schemaUrl": "https://r",
                "scopeLogs": [
                    {
                        "scope": {"name": "lib", "version": "2", "droppedAttributesCount": 3},
                        "schemaUrl": "https://s",
                        "logRecords": records,
                    }
                ],
            }
        ]
    }


def span_batch(spans, resource=()):
    return {
        "resourceSpans": [
            {
                "resource": {"attributes": list(resource)},
                "scopeSpans": [{"scope": {"name": "lib"}, "spans": spans}],
            }
        ]
    }


def metric_batch(*metrics):
    return {
        "resourceMetrics": [
            {
                "resource": {"attributes": [kv("service.name", stringValue="api")]},
                "scopeMetrics": [{"scope": {"name": "lib"}, "metrics": list(metrics)}],
            }
        ]
    }


def test_log_row(spark, tmp_path):
    record = {
        "timeUnixNano": "1704067200123456789",
        "observedTimeUnixNano": "1704067201000000001",
        "severityNumber": 17,
        "severityText": "ERROR",
        "body": {"stringValue": "boom"},
        "attributes": [kv("a", intValue="5")],
        "flags": 1,
        "traceId": TRACE,
        "spanId": SPAN,
        "droppedAttributesCount": 2,
    }
    resource = [
        kv("service.name", stringValue="api"),
        kv("service.version", stringValue="1.2"),
    ]
    path = write(tmp_path / "a.json", log_batch([record], resource))
    (row,) = R.to_logs_rows(B.read_otlp_logs(spark, path)).collect()
    assert row.TimestampNanos == 1704067200123456789
    assert row.Timestamp.microsecond == 123456
    assert row.ObservedTimestampNanos == 1704067201000000001
    assert (row.TraceId, row.SpanId, row.TraceFlags) == (TRACE, SPAN, 1)
    assert (row.SeverityText, row.SeverityNumber, row.Body) == ("ERROR", 17, "boom")
    assert (row.ServiceName, row.ServiceVersion) == ("api", "1.2")
    assert (row.ScopeName, row.ScopeVersion, row.ScopeDroppedAttrCount) == ("lib", "2", 3)
    assert (row.ResourceSchemaUrl, row.ScopeSchemaUrl) == ("https://r", "https://s")
    assert row.LogAttributes == {"a": "5"}
    assert row.LogDroppedAttrCount == 2


@pytest.mark.parametrize(
    "value, expected",
    [
        ({"stringValue": "x"}, "x"),
        ({"stringValue": ""}, ""),
        ({"intValue": "42"}, "42"),
        ({"intValue": 42}, "42"),
        ({"boolValue": True}, "true"),
        ({"boolValue": False}, "false"),
        ({"doubleValue": 1.5}, "1.5"),
        ({"doubleValue": 3}, "3"),
        ({"doubleValue": 3.0}, "3"),
        ({"doubleValue": 0.1}, "0.1"),
        ({"doubleValue": 12345678.25}, "12345678.25"),
        ({"doubleValue": 1e20}, "100000000000000000000"),
        ({"doubleValue": 1e21}, "1e+21"),
        ({"doubleValue": 2.5e-5}, "0.000025"),
        ({"doubleValue": 2.5e-7}, "2.5e-7"),
        ({"doubleValue": -0.25}, "-0.25"),
        ({"bytesValue": "AQI="}, "AQI="),
        (
            {"arrayValue": {"values": [{"intValue": "1"}, {"stringValue": "b"}]}},
            '{"values":[{"intValue":"1"},{"stringValue":"b"}]}',
        ),
        (
            {"kvlistValue": {"values": [{"key": "k", "value": {"boolValue": True}}]}},
            '{"values":[{"key":"k","value":{"boolValue":true}}]}',
        ),
        ({}, ""),
    ],
)
def test_value_kinds(spark, tmp_path, value, expected):
    batch = log_batch([{"timeUnixNano": "1", "body": value, "attributes": [kv("v", **value)]}])
    path = write(tmp_path / "a.json", batch)
    (row,) = R.to_logs_rows(B.read_otlp_logs(spark, path)).collect()
    assert row.Body == expected
    assert row.LogAttributes == {"v": expected}


def test_duplicate_keys_keep_the_last(spark, tmp_path):
    attrs = [kv("a", intValue="1"), kv("b", intValue="2"), kv("a", intValue="3")]
    path = write(tmp_path / "a.json", log_batch([{"timeUnixNano": "1", "attributes": attrs}]))
    (row,) = R.to_logs_rows(B.read_otlp_logs(spark, path)).collect()
    assert row.LogAttributes == {"a": "3", "b": "2"}


def test_missing_fields_are_empty(spark, tmp_path):
    path = write(tmp_path / "a.json", log_batch([{}]))
    (row,) = R.to_logs_rows(B.read_otlp_logs(spark, path)).collect()
    assert (row.TraceId, row.SpanId, row.Body, row.ServiceName) == ("", "", "", "")
    assert row.TimestampNanos == 0
    assert row.LogAttributes == {}


def test_empty_levels_and_summary(spark, tmp_path):
    path = write(
        tmp_path / "a.json",
        {"resourceLogs": [{"resource": {}}, {"resource": {}, "scopeLogs": []}]},
        {"resourceLogs": [{"scopeLogs": [{"scope": {}}, {"logRecords": []}]}]},
        {"resourceLogs": []},
        {},
        log_batch([{"timeUnixNano": "1"}, {"timeUnixNano": "2"}]),
    )
    batches = B.read_batches(spark, "logs", path)
    assert B.flatten(batches, "logs").count() == 2
    counts = sorted(tuple(r) for r in B.batch_summary_logs(batches).collect())
    assert counts == [(0, 0), (0, 0), (1, 0), (1, 2), (2, 0)]


def test_metric_summary_counts_metrics_not_points(spark, tmp_path):
    metric = {"name": "m", "gauge": {"dataPoints": [{"asInt": "1"}, {"asInt": "2"}]}}
    path = write(tmp_path / "a.json", metric_batch(metric, {"name": "n"}))
    (row,) = B.batch_summary_metrics(B.read_batches(spark, "metrics", path)).collect()
    assert tuple(row) == (1, 2)


def test_malformed_lines_are_kept(spark, tmp_path):
    wrong_kind = json.dumps(log_batch([{"severityNumber": "high"}]))
    path = write(
        tmp_path / "a.json", "{not json", wrong_kind, log_batch([{"timeUnixNano": "1"}])
    )
    batches = B.read_batches(spark, "logs", path)
    assert B.flatten(batches, "logs").count() == 1
    rejects = B.rejected_lines(spark, "logs", path)
    assert {r.Raw for r in rejects.collect()} == {"{not json", wrong_kind}
    assert rejects.count() == 2
    kept = batches.persist()
    assert B.malformed(kept).count() == 2
    kept.unpersist()


def test_out_of_range_integers_are_rejected_not_zeroed(spark, tmp_path):
    path = write(
        tmp_path / "a.json",
        log_batch([{"timeUnixNano": BIG, "body": {"stringValue": "late"}}, {"timeUnixNano": "7"}]),
    )
    records = B.read_otlp_logs(spark, path)
    assert [r.TimestampNanos for r in R.to_logs_rows(records).collect()] == [7]
    (reject,) = R.log_rejects(records).collect()
    assert BIG in reject.Raw and "late" in reject.Raw


def test_span_row_and_detail(spark, tmp_path):
    span = {
        "traceId": TRACE,
        "spanId": SPAN,
        "name": "GET /",
        "kind": 2,
        "startTimeUnixNano": "1000",
        "endTimeUnixNano": "4500",
        "status": {"code": 2, "message": "bad"},
        "events": [
            {"timeUnixNano": "1500", "name": "x", "attributes": [kv("e", boolValue=True)]}
        ],
        "links": [{"traceId": "aa", "spanId": "bb", "traceState": "s"}],
    }
    backwards = {"spanId": "cc", "startTimeUnixNano": "5000", "endTimeUnixNano": "4000"}
    path = write(tmp_path / "a.json", span_batch([span, backwards]))
    records = B.read_otlp_traces(spark, path)
    rows = {r.SpanId: r for r in R.to_span_rows(records).collect()}
    good = rows[SPAN]
    assert (good.Duration, good.SpanKind, good.StatusCode) == (3500, "Server", "Error")
    assert good.Events[0].TimestampNanos == 1500
    assert good.Events[0].Attributes == {"e": "true"}
    assert good.Links[0].TraceState == "s"
    assert rows["cc"].Duration == 0
    assert (rows["cc"].SpanKind, rows["cc"].StatusCode) == ("Unspecified", "Unset")
    assert rows["cc"].Events == [] and rows["cc"].Links == []
    detail = {r.span_id: r.duration for r in R.span_detail(records).collect()}
    assert detail == {SPAN: 3500, "cc": -1000}


POINT = {"startTimeUnixNano": "10", "timeUnixNano": "20", "attributes": [kv("d", stringValue="x")]}
ALL_TYPES = [
    {
        "name": "g",
        "description": "d",
        "unit": "1",
        "gauge": {
            "dataPoints": [
                {
                    **POINT,
                    "asDouble": 2.5,
                    "exemplars": [
                        {"timeUnixNano": "15", "asInt": "7", "spanId": SPAN, "traceId": TRACE}
                    ],
                }
            ]
        },
    },
    {
        "name": "s",
        "sum": {
            "dataPoints": [{**POINT, "asInt": "9"}],
            "aggregationTemporality": 2,
            "isMonotonic": True,
        },
    },
    {
        "name": "h",
        "histogram": {
            "aggregationTemporality": 1,
            "dataPoints": [
                {
                    **POINT,
                    "count": "3",
                    "sum": 6.0,
                    "bucketCounts": ["1", "2"],
                    "explicitBounds": [1.0],
                    "min": 0.5,
                },
                {**POINT, "count": "3", "bucketCounts": ["1", "2"], "explicitBounds": [1.0, 2.0]},
                {**POINT, "count": "4", "sum": 8.0},
            ],
        },
    },
    {
        "name": "e",
        "exponentialHistogram": {
            "aggregationTemporality": 1,
            "dataPoints": [
                {
                    **POINT,
                    "count": "4",
                    "sum": 1.0,
                    "scale": 3,
                    "zeroCount": "1",
                    "positive": {"offset": -2, "bucketCounts": ["1", "0", "1"]},
                    "negative": {"offset": 4, "bucketCounts": ["1"]},
                }
            ],
        },
    },
    {
        "name": "q",
        "summary": {
            "dataPoints": [
                {
                    **POINT,
                    "count": "2",
                    "sum": 3.0,
                    "quantileValues": [{"quantile": 0.5, "value": 1.0}],
                }
            ]
        },
    },
    {"name": "none", "gauge": {"dataPoints": []}},
    {"name": "empty"},
]


def test_metric_routing(spark, tmp_path):
    path = write(tmp_path / "a.json", metric_batch(*ALL_TYPES))
    records = B.read_otlp_metrics(spark, path)
    types = {r.name: r.type for r in R.metric_detail(records).collect()}
    assert types == {
        "g": "Gauge",
        "s": "Sum",
        "h": "Histogram",
        "e": "ExponentialHistogram",
        "q": "Summary",
        "none": "Gauge",
        "empty": "Empty",
    }
    root = str(tmp_path / "out")
    S.write_metrics(records, root)
    tables = {t: S.read_table(spark, t, S.metric_path(root, t)).collect() for t in S.METRIC_TABLES}
    (g,) = tables["gauge"]
    assert (g.Value, g.ServiceName, g.SeriesKey, g.TimeUnixNanos) == (2.5, "api", '{"d":"x"}', 20)
    assert (g.Exemplars[0].Value, g.Exemplars[0].TraceId) == (7.0, TRACE)
    (s,) = tables["sum"]
    assert (s.Value, s.AggregationTemporality, s.IsMonotonic) == (9.0, 2, True)
    assert len(tables["histogram"]) == 2
    h = {r.Count: r for r in tables["histogram"]}
    assert (h[3].BucketCounts, h[3].ExplicitBounds) == ([1, 2], [1.0])
    assert (h[3].Min, h[3].Max) == (0.5, None)
    assert (h[4].BucketCounts, h[4].Sum) == ([], 8.0)
    (e,) = tables["exponential_histogram"]
    assert (e.Scale, e.PositiveOffset, e.PositiveBucketCounts) == (3, -2, [1, 0, 1])
    assert (e.NegativeOffset, e.NegativeBucketCounts, e.ZeroCount) == (4, [1], 1)
    (q,) = tables["summary"]
    assert [tuple(v) for v in q.ValueAtQuantiles] == [(0.5, 1.0)]
    (reject,) = spark.read.parquet(f"{root}/rejects").collect()
    assert '"explicitBounds":[1.0,2.0]' in reject.Raw


def test_bad_points_are_rejected(spark, tmp_path):
    metric = {
        "name": "s",
        "sum": {"dataPoints": [{**POINT, "asInt": BIG}, {**POINT, "timeUnixNano": "1.5"}]},
    }
    path = write(tmp_path / "a.json", metric_batch(metric))
    records = B.read_otlp_metrics(spark, path)
    assert R.to_sum_rows(records).count() == 0
    assert R.point_rejects(records).count() == 2


# ---------------------------------------------------------------- batches made from events


def own_events(spark, out, n):
    """A folder with `n` events of our own, in one file."""
    rows = spark.range(n).selectExpr(
        "id AS event_id",
        "CAST(TIMESTAMP'2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, 0, 0, id) AS TIMESTAMP_NTZ) AS ts",
        "id % 50 AS user_id",
        "element_at(array('view', 'click', 'error'), CAST(id % 3 AS INT) + 1) AS event_type",
        "CAST(id % 900 AS DOUBLE) / 4 AS value",
        "concat('{\"k\": ', id % 100, '}') AS props",
    )
    rows.coalesce(1).write.parquet(f"{out}/sf/events.parquet")
    return f"{out}/sf"


@pytest.mark.parametrize("signal", ["logs", "traces", "metrics"])
def test_batches_are_made_with_one_narrow_shuffle_and_compressed(spark, out, signal):
    """Batches are ten times as large as their events: they are neither shuffled nor stored as they are."""
    source = own_events(spark, out, 2_000)
    write = {
        "logs": wire.write_log_batches,
        "traces": wire.write_span_batches,
        "metrics": wire.write_mixed_metric_batches,
    }[signal]
    path = write(spark, source, f"{out}/in")
    stored = sum(os.path.getsize(f"{path}/{f}") for f in os.listdir(path) if not f.startswith((".", "_")))
    text = spark.read.text(path)
    assert text.agg(F.sum(F.length("value"))).first()[0] > 4 * stored
    assert text.count() == 50

    rows = inputs.logs_of(wire._batched(spark, source), "_batch", "event_id")
    lines = wire._lines(rows, "named_struct('body', Body)", "array()", ("a", "b", "c"), ["ServiceName"])
    plan = plan_text(lines)
    assert plan.count("Exchange hashpartitioning") == 1
    shuffled = plan[plan.index("Exchange hashpartitioning") :]
    assert "Body" not in shuffled and "ServiceName" not in shuffled


def test_files_of_points_hold_as_many_records_as_files_of_logs(spark, out):
    """Streams take so many files at a time, so small files make many micro-batches, each with its own jobs."""
    source = own_events(spark, out, 15_000)
    path = wire.write_metric_batches(spark, source, f"{out}/in", compression="none")
    sizes = spark.read.text(path).groupBy(F.input_file_name()).count().collect()
    assert sum(n == 15_000 for _, n in sizes) == 2  # gauges and sums, a file each
    assert all(f.endswith(".txt") for f in os.listdir(path) if not f.startswith((".", "_")))  # tasks can share a file


def test_signals_are_ingested_together(spark, out, monkeypatch):
    """Each signal waits until all three are at their ingest; one after the other, the first would give up."""
    source, all_here = own_events(spark, out, 400), threading.Barrier(3, timeout=120)
    real = queries.ingest
    monkeypatch.setattr(queries, "ingest", lambda *args: (all_here.wait(), real(*args))[1])
    rows = queries.QUERIES["ingest_rejects"](spark, source).collect()
    assert {r["signal"] for r in rows} == {"logs", "traces", "metrics"}
    assert {r["table_name"] for r in rows} == {"logs", "traces", "gauge", "sum", "histogram", "none"}
