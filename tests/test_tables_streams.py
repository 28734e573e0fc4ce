"""Tables, retention and streams."""

import json
import os
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from signalbarn.functions.columns import ttl_seconds
from signalbarn.operators import traces as T
from signalbarn.plans import inputs, wire
from signalbarn.sources import tables as S
from signalbarn.streaming.ingest import stream_ingest, stream_route_metrics, stream_trace_lookup
from tests.conftest import SF_SMALL


def same_rows(a, b):
    text = [F.to_json(F.struct(*sorted(a.columns))).alias("j")]
    left, right = a.select(*text), b.select(*text)
    return left.exceptAll(right).count() == 0 and right.exceptAll(left).count() == 0


def test_files_are_sorted_and_partitioned(spark, out):
    S.write_traces(inputs.spans(spark, SF_SMALL), out)
    days = sorted(d for d in os.listdir(out) if d.startswith("EventDate="))
    assert days[0] == "EventDate=2024-01-01" and len(days) == 30
    part = spark.read.parquet(f"{out}/{days[3]}")
    rows = [(r.ServiceName, r.SpanName, r.TimestampNanos) for r in part.collect()]
    assert rows == sorted(rows)


def test_a_large_day_is_split_over_files(spark, out):
    """One day holds everything; the write must not be one task."""
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    old = spark.conf.get(size)
    spark.conf.set(size, "200KB")
    try:
        one_day = inputs.spans(spark, SF_SMALL).withColumn("Timestamp", F.lit(datetime(2024, 1, 1)))
        many = one_day.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(30)))).repartition(8)
        S.write_traces(many, out)
    finally:
        spark.conf.set(size, old)
    files = [f for f in os.listdir(f"{out}/EventDate=2024-01-01") if f.endswith(".parquet")]
    assert len(files) > 1
    assert S.read_table(spark, "traces", out).count() == 30 * 1000


def test_scan_is_half_open(spark, out):
    rows = inputs.logs(spark, SF_SMALL)
    S.write_logs(rows, out)
    first = rows.orderBy("TimestampNanos").select("TimestampNanos").limit(20).collect()
    lo, hi = first[5][0], first[15][0]
    assert S.scan(spark, "logs", out, lo, hi).count() == 10
    assert S.scan(spark, "logs", out).count() == 1000
    assert S.scan(spark, "logs", out, None, lo).count() == 5


@pytest.mark.parametrize(
    "ttl, seconds",
    [
        (timedelta(days=2), 172800),
        (timedelta(hours=5), 18000),
        (timedelta(minutes=7), 420),
        (timedelta(seconds=9, milliseconds=900), 9),
        (timedelta(milliseconds=500), 0),
        (timedelta(0), 0),
        (timedelta(seconds=-5), 0),
    ],
)
def test_ttl_seconds(ttl, seconds):
    assert ttl_seconds(ttl) == seconds


def test_expire_rows(spark):
    df = spark.sql(
        "SELECT * FROM VALUES (TIMESTAMP'2024-01-01 00:00:00.9'), (TIMESTAMP'2024-01-01 00:00:01') AS v(t)"
    )
    now = datetime(2024, 1, 2, 0, 0, 0)
    # The fraction of the time is cut off: the first row expires at exactly `now`.
    assert S.expire_rows(df, "t", timedelta(days=1), now).count() == 1
    assert S.expire_rows(df, "t", timedelta(0), now).count() == 2
    # Less than a second counts as 0 seconds, which is not the same as no retention.
    assert S.expire_rows(df, "t", timedelta(milliseconds=1), datetime(2024, 1, 1)).count() == 1


def test_catalog_tables_and_dropping_days(spark, out):
    names = S.ensure_tables(spark, "signals_test", f"{out}/db")
    assert S.ensure_tables(spark, "signals_test", f"{out}/db") == names
    assert len(names) == 8 and "signals_test.otel_metrics_exponential_histogram" in names
    S.insert_rows(inputs.spans(spark, SF_SMALL), "traces", "signals_test.otel_traces")
    ttl, now = timedelta(days=20), datetime(2024, 1, 25, 12)
    dropped = S.drop_expired(spark, "traces", "signals_test.otel_traces", ttl, now)
    assert dropped == [date(2024, 1, d) for d in range(1, 5)]
    left = spark.table("signals_test.otel_traces")
    # The day that is only partly expired stays whole.
    assert left.agg(F.min("EventDate")).first()[0] == date(2024, 1, 5)
    assert S.drop_expired(spark, "traces", "signals_test.otel_traces", ttl, now) == []
    assert S.drop_expired(spark, "traces", "signals_test.otel_traces", timedelta(0), now) == []


def test_default_database_is_not_created(spark):
    names = S.ensure_tables(spark, "")
    assert names[0] == "otel_logs"
    assert spark.table("otel_logs").count() == 0


# ---------------------------------------------------------------- streams


def test_stream_equals_batch(spark, out):
    source = wire.write_log_batches(spark, SF_SMALL, f"{out}/in", files=3)
    q = stream_ingest(spark, "logs", source, f"{out}/t", f"{out}/c", max_files=1)
    q.awaitTermination()
    stored = S.read_table(spark, "logs", f"{out}/t/rows")
    columns = ["TraceId", "SpanId", "TimestampNanos", "Body", "ServiceName", "SeverityNumber"]
    assert same_rows(stored.select(*columns), inputs.logs(spark, SF_SMALL).select(*columns))


def test_replayed_batch_changes_nothing(spark, out):
    """A batch whose commit was lost is written again over itself."""
    source = wire.write_span_batches(spark, SF_SMALL, f"{out}/in", files=2)
    args = (spark, "traces", source, f"{out}/t", f"{out}/c")
    stream_ingest(*args, max_files=1).awaitTermination()
    before = S.read_table(spark, "traces", f"{out}/t/rows").count()
    commits = f"{out}/c/commits"
    last = max(int(f) for f in os.listdir(commits) if f.isdigit())
    os.remove(f"{commits}/{last}")
    crc = f"{commits}/.{last}.crc"
    if os.path.exists(crc):
        os.remove(crc)
    stream_ingest(*args, max_files=1).awaitTermination()
    assert os.path.exists(f"{commits}/{last}")
    spark.catalog.refreshByPath(f"{out}/t/rows")
    assert S.read_table(spark, "traces", f"{out}/t/rows").count() == before == 1000


def test_second_stream_adds_to_the_table(spark, out):
    """A new checkpoint starts at batch 0 again and must not overwrite old rows."""
    for n in ("a", "b"):
        source = wire.write_span_batches(spark, SF_SMALL, f"{out}/in-{n}", files=1)
        stream_ingest(spark, "traces", source, f"{out}/t", f"{out}/c-{n}").awaitTermination()
    spark.catalog.refreshByPath(f"{out}/t/rows")
    assert S.read_table(spark, "traces", f"{out}/t/rows").count() == 2000


def test_stream_rejects(spark, out):
    os.makedirs(f"{out}/in")
    record = {"timeUnixNano": str(2**63), "body": {"stringValue": "far"}}
    good = {"timeUnixNano": "5", "body": {"stringValue": "near"}}
    batch = {"resourceLogs": [{"scopeLogs": [{"logRecords": [record, good]}]}]}
    with open(f"{out}/in/a.json", "w") as f:
        f.write(json.dumps(batch) + "\n{broken\n")
    stream_ingest(spark, "logs", f"{out}/in", f"{out}/t", f"{out}/c").awaitTermination()
    assert [r.Body for r in S.read_table(spark, "logs", f"{out}/t/rows").collect()] == ["near"]
    rejects = spark.read.option("recursiveFileLookup", "true").parquet(f"{out}/t/rejects").collect()
    assert sorted(r.Level for r in rejects) == ["line", "record"]


def test_lookup_stream_partial_rows(spark, out):
    """A trace whose spans arrive in two batches leaves two partial rows."""
    for n, rows in enumerate(
        [
            [("t1", 10), ("t1", 11), ("t2", 12), ("", 13)],
            [("t1", 90), ("t3", 91)],
        ]
    ):
        df = spark.createDataFrame(rows, "TraceId string, second bigint").withColumn("one", F.lit(1))
        wide = inputs.spans(spark, SF_SMALL).limit(1).drop("TraceId", "TimestampNanos", "Timestamp")
        full = df.join(wide.withColumn("one", F.lit(1)), "one").withColumns(
            {
                "TimestampNanos": F.col("second") * 1_000_000_000 + 7,
                "Timestamp": F.timestamp_seconds("second"),
            }
        )
        S.write_traces(full, f"{out}/spans")
        stream_trace_lookup(spark, f"{out}/spans", f"{out}/lookup", f"{out}/c").awaitTermination()
    spark.catalog.refreshByPath(f"{out}/lookup")
    lookup = S.read_table(spark, "lookup", f"{out}/lookup")
    assert lookup.filter("TraceId = 't1'").count() == 2
    assert lookup.filter("TraceId = ''").count() == 0
    got = {
        r.TraceId: (r.Start.second + 60 * r.Start.minute, r.End.second + 60 * r.End.minute)
        for r in T.collapse_lookup(lookup).collect()
    }
    assert got == {"t1": (10, 90), "t2": (12, 12), "t3": (91, 91)}


def test_metric_stream(spark, out):
    source = wire.write_metric_batches(spark, SF_SMALL, f"{out}/in", files=2)
    stream_route_metrics(spark, source, f"{out}/t", f"{out}/c").awaitTermination()
    counts = {
        t: S.read_table(spark, t, S.metric_path(f"{out}/t", t)).count() for t in S.METRIC_TABLES
    }
    assert counts["gauge"] == counts["sum"] == 1000
    assert counts["histogram"] == inputs.histogram(spark, SF_SMALL).count()
    assert counts["exponential_histogram"] == counts["summary"]
