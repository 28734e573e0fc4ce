"""Ingest that accounts for every record, exactly-once publishing, merged and dropped days."""

import json
import os
import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from signalbarn.functions.files import Store
from signalbarn.operators import logs as L
from signalbarn.operators import rows as R
from signalbarn.operators import traces as T
from signalbarn.plans import inputs, wire
from signalbarn.plans.queries import _metric_view
from signalbarn.schemas import METRIC_TABLES
from signalbarn.sources import batches as B
from signalbarn.sources import staging
from signalbarn.sources import tables as S
from signalbarn.sources.ingest import ingest
from signalbarn.streaming import commit
from signalbarn.streaming.ingest import stream_ingest, stream_route_metrics, stream_trace_lookup
from tests.conftest import SF_SMALL, formatted, plan_text

BIG = str(2**63)


def lines(path, *values):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        for v in values:
            f.write((v if isinstance(v, str) else json.dumps(v)) + "\n")
    return str(path)


def metrics(*each):
    return {"resourceMetrics": [{"scopeMetrics": [{"metrics": list(each)}]}]}


def test_one_read_accounts_for_logs(spark, out):
    record = {"timeUnixNano": "5", "body": {"stringValue": "near"}}
    batch = {"resourceLogs": [{"scopeLogs": [{"logRecords": [record, {"timeUnixNano": BIG}, None]}, {"logRecords": []}]}, {}]}
    path = lines(f"{out}/in/a.json", batch, "{broken", {"resourceLogs": []}, {}, batch, '{"resourceLogs": 7}')
    counts = ingest(spark, "logs", path, f"{out}/t")
    assert counts == {("row", "logs"): 4, ("record", "logs"): 2, ("line", "none"): 2}
    stored = S.read_table(spark, "logs", f"{out}/t/otel_logs")
    assert sorted(r.Body for r in stored.collect()) == ["", "", "near", "near"]
    rejects = S.read_rejects(spark, f"{out}/t/rejects").collect()
    assert sorted(r.Level for r in rejects) == ["line", "line", "record", "record"]
    assert sorted(r.Raw for r in rejects if r.Level == "line") == ['{"resourceLogs": 7}', "{broken"]
    assert all(BIG in r.Raw for r in rejects if r.Level == "record")
    assert ingest(spark, "logs", lines(f"{out}/none/a.json"), f"{out}/u") == {}


def test_an_account_that_does_not_balance_fails(spark, out, monkeypatch):
    batch = {"resourceLogs": [{"scopeLogs": [{"logRecords": [{"timeUnixNano": "1"}, {"timeUnixNano": "2"}]}]}]}
    path = lines(f"{out}/in/a.json", batch)
    lose = lambda batches, signal: B.flatten_all(batches, signal).filter("record.timeUnixNano = '1'")
    monkeypatch.setattr(staging, "flatten_all", lose)
    with pytest.raises(staging.UnbalancedIngest):
        ingest(spark, "logs", path, f"{out}/t")
    assert not os.path.exists(f"{out}/t")


def test_one_read_routes_all_kinds_of_points(spark, out):
    attribute = {"key": "a", "value": {"stringValue": "b"}}
    exemplar = {"timeUnixNano": "4", "asDouble": 1.5, "spanId": "s", "traceId": "t", "filteredAttributes": [attribute]}
    point = {"attributes": [attribute], "timeUnixNano": "9", "startTimeUnixNano": "3"}
    several = metrics(
        {"name": "g", "unit": "u", "gauge": {"dataPoints": [{**point, "asDouble": 2.5, "exemplars": [exemplar]}, {**point, "asInt": BIG}]}},
        {"name": "s", "sum": {"dataPoints": [{**point, "asInt": "7"}], "aggregationTemporality": 2, "isMonotonic": True}},
        {"name": "h", "histogram": {"dataPoints": [{**point, "count": "3", "sum": 4.0, "bucketCounts": ["1", "2"], "explicitBounds": [1.0], "min": 0.5}, {**point, "bucketCounts": ["1"], "explicitBounds": [1.0]}], "aggregationTemporality": 1}},
        {"name": "e", "exponentialHistogram": {"dataPoints": [{**point, "count": "6", "scale": 2, "zeroCount": "1", "positive": {"offset": -1, "bucketCounts": ["2"]}, "negative": {"offset": 3, "bucketCounts": ["1", "2"]}}]}},
        {"name": "q", "summary": {"dataPoints": [{**point, "count": "2", "sum": 3.0, "quantileValues": [{"quantile": 0.5, "value": 1.0}]}]}},
        {"name": "no points"},
        {"name": "none either", "gauge": {"dataPoints": []}},
    )
    path = lines(f"{out}/in/a.json", several, "[", several)
    records = B.read_otlp_metrics(spark, path)
    want = {t: sorted(map(str, df.collect())) for t, df in R.route_metrics(records).items()}
    counts = ingest(spark, "metrics", path, f"{out}/t")
    assert counts == {
        ("row", "gauge"): 2, ("row", "sum"): 2, ("row", "histogram"): 2, ("row", "exponential_histogram"): 2,
        ("row", "summary"): 2, ("point", "gauge"): 2, ("point", "histogram"): 2, ("line", "none"): 1,
    }
    S.write_metrics(records, f"{out}/w")
    for target in (f"{out}/t", f"{out}/w"):
        for table in METRIC_TABLES:
            stored = S.read_table(spark, table, S.metric_path(target, table)).drop("EventDate")
            assert sorted(map(str, stored.collect())) == want[table] and want[table]
    assert S.read_rejects(spark, f"{out}/w/rejects").count() == 4


def test_metrics_are_parsed_once(spark, out):
    path = lines(f"{out}/in/a.json", metrics({"name": "g", "gauge": {"dataPoints": [{"asInt": "1"}]}}))
    tagged = R.tagged_rows(B.flatten_all(B.read_batches(spark, "metrics", path), "metrics"), "metrics")
    text = plan_text(tagged)
    assert text.count("FileScan json") == 1 and "Exchange" not in text
    staged = staging.stage(B.read_batches(spark, "metrics", path), "metrics", f"{out}/staged")
    own = formatted(staged.rows("gauge").select("Value"))
    assert "Kind" in own.split("PartitionFilters:")[1].split("\n")[0]
    assert "ReadSchema: struct<Value:double>" in own


def test_every_signal_with_several_metrics_in_a_batch(spark, out):
    path = wire.write_mixed_metric_batches(spark, SF_SMALL, f"{out}/in")
    counts = ingest(spark, "metrics", path, f"{out}/t")
    assert counts == {("row", t): 1000 for t in ("gauge", "sum", "histogram")}
    one_batch = B.batch_summary_metrics(B.read_batches(spark, "metrics", path)).agg(F.max("record_count")).first()
    assert one_batch[0] > 3
    gauge = S.read_table(spark, "gauge", S.metric_path(f"{out}/t", "gauge"))
    assert gauge.agg(F.sum(F.size("Exemplars"))).first()[0] == 1000


# ---------------------------------------------------------------- publishing


class Crash(Exception):
    pass


def catalog(spark, out, name):
    names = S.ensure_tables(spark, name, f"{out}/db")
    return dict(zip(S.TABLES, names))


@pytest.mark.parametrize("where", ["before the plan", "before any move", "between moves", "before the ledger"])
def test_replay_neither_doubles_nor_loses(spark, out, monkeypatch, where):
    """A micro-batch breaks off once at each step; the stream is started again."""
    names = catalog(spark, out, f"replay_{where.replace(' ', '_')}")
    source = wire.write_span_batches(spark, SF_SMALL, f"{out}/in", files=2)
    args = dict(max_files=1, tables={"traces": names["traces"]})
    run = lambda: stream_ingest(spark, "traces", source, f"{out}/t", f"{out}/c", **args).awaitTermination()
    calls = {"n": 0}

    def once(fn, at):
        def wrapped(*a, **k):
            calls["n"] += 1
            if calls["n"] == at:
                raise Crash(where)
            return fn(*a, **k)

        return wrapped

    if where == "before the plan":
        monkeypatch.setattr(commit, "_planned", once(commit._planned, 1))
    elif where == "before any move":
        monkeypatch.setattr(commit, "_publish", once(commit._publish, 1))
    elif where == "between moves":
        monkeypatch.setattr(Store, "move", once(Store.move, 5))
    else:
        monkeypatch.setattr(commit, "add_days", once(commit.add_days, 1))
    with pytest.raises(Exception, match=where):
        run()
    run()
    stored = spark.table(names["traces"])
    assert stored.count() == stored.select("SpanId").distinct().count() == 1000
    location = S.table_location(spark, names["traces"]).removeprefix("file:")
    assert not [d for d in os.listdir(location) if not d.startswith("EventDate=")]
    notes = [f for f in os.listdir(f"{out}/t/_ledger") if f.endswith(".json")]
    assert len(notes) == 1 and json.load(open(f"{out}/t/_ledger/{notes[0]}"))["last"] >= 1
    left = [f for f in os.listdir(f"{out}/t/_ledger") if not f.endswith((".json", ".crc"))]
    assert left == []


def test_streams_fill_the_created_tables(spark, out):
    """All signals into the catalog, spans further into the lookup; days appear without a BatchId."""
    names = catalog(spark, out, "streams_into_tables")
    logs = wire.write_log_batches(spark, SF_SMALL, f"{out}/logs", files=2)
    stream_ingest(spark, "logs", logs, f"{out}/l", f"{out}/cl", max_files=1, tables=names).awaitTermination()
    assert spark.table(names["logs"]).count() == 1000
    assert spark.table(names["logs"]).filter("EventDate = DATE'2024-01-03'").count() > 0
    folder = S.table_location(spark, names["logs"]).removeprefix("file:")
    assert {len(os.listdir(f"{folder}/{d}")) > 0 for d in os.listdir(folder)} == {True}
    assert all("=" not in f for d in os.listdir(folder) for f in os.listdir(f"{folder}/{d}"))

    source = wire.write_metric_batches(spark, SF_SMALL, f"{out}/metrics", files=1)
    stream_route_metrics(spark, source, f"{out}/m", f"{out}/cm", tables=names).awaitTermination()
    for t in METRIC_TABLES:
        assert spark.table(names[t]).count() > 0

    spans = wire.write_span_batches(spark, SF_SMALL, f"{out}/spans", files=2)
    stream_ingest(spark, "traces", spans, f"{out}/s", f"{out}/cs", max_files=1, tables=names).awaitTermination()
    location = S.table_location(spark, names["lookup"])
    stream_trace_lookup(
        spark, S.table_location(spark, names["traces"]), location, f"{out}/ck", full_name=names["lookup"]
    ).awaitTermination()
    want = T.trace_id_ts(inputs.spans(spark, SF_SMALL))
    got = T.collapse_lookup(spark.table(names["lookup"]))
    assert got.exceptAll(want).count() == want.exceptAll(got).count() == 0


def test_stream_promotes_attributes(spark, out):
    promoted = {"LogAttributes": ["k"]}
    names = dict(zip(S.TABLES, S.ensure_tables(spark, "promoted_stream", f"{out}/db", {"logs": promoted})))
    S.insert_rows(inputs.logs(spark, SF_SMALL).limit(10), "logs", names["logs"])  # rows without the promotion
    source = wire.write_log_batches(spark, SF_SMALL, f"{out}/in", files=1)
    stream_ingest(spark, "logs", source, f"{out}/t", f"{out}/c", tables=names, promoted=promoted).awaitTermination()
    stored = spark.table(names["logs"])
    assert stored.filter("attr_LogAttributes_k IS NULL").count() == 10
    want = inputs.logs(spark, SF_SMALL).filter("LogAttributes['k'] = '42'").count()
    first = inputs.logs(spark, SF_SMALL).limit(10).filter("LogAttributes['k'] = '42'").count()
    assert T.where_attr_equals(stored, "LogAttributes", "k", "42").count() == want + first


def test_promoted_and_plain_files_together(spark, out):
    keys = {"ResourceAttributes": ["service.name"]}
    rows = inputs.logs(spark, SF_SMALL)
    S.write_table(rows, "logs", f"{out}/logs")
    S.write_table(S.with_promoted(rows, keys), "logs", f"{out}/logs")
    stored = S.scan(spark, "logs", f"{out}/logs", promoted=keys)
    found = T.where_attr_equals(stored, "ResourceAttributes", "service.name", "svc-3")
    assert found.count() == 2 * rows.filter("ServiceName = 'svc-3'").count()
    assert "Or(EqualTo(attr_ResourceAttributes_service_2e_name,svc-3),IsNull(attr_ResourceAttributes_service_2e_name))" in formatted(found)


# ---------------------------------------------------------------- days


def text_rows(df):
    return sorted(r[0] for r in df.select(F.to_json(F.struct(*sorted(df.columns)))).collect())


def test_merged_days_hold_the_same_rows(spark, out):
    names = catalog(spark, out, "merged_days")
    rows = inputs.spans(spark, SF_SMALL)
    for part in range(3):
        S.insert_rows(rows.filter(F.crc32(F.col("SpanId").cast("binary")) % 3 == part), "traces", names["traces"])
    before = text_rows(spark.table(names["traces"]))
    reader = spark.table(names["traces"]).filter("EventDate < DATE'2024-01-10'").select("SpanId")
    plan_text(reader)
    merged = S.merge_days(spark, "traces", names["traces"], date(2024, 1, 10))
    assert [m.day for m in merged] == [f"2024-01-{d:02d}" for d in range(1, 10)]
    assert all(m.files == 1 and len(m.replaced) >= 3 for m in merged)
    assert text_rows(spark.table(names["traces"])) == before
    assert reader.count() > 0  # planned before the swap, reads the old files
    part = spark.read.parquet(merged[3].folder).select("ServiceName", "SpanName", "TimestampNanos").collect()
    assert part == sorted(part)
    assert S.merge_days(spark, "traces", names["traces"], date(2024, 1, 10)) == []
    assert S.drop_replaced(spark, merged) == sum(len(m.replaced) for m in merged)
    spark.catalog.refreshTable(names["traces"])
    assert text_rows(spark.table(names["traces"])) == before
    # late rows of a merged day are found, and merged by the next call
    S.insert_rows(rows.filter("EventDate = DATE'2024-01-02'").limit(2), "traces", names["traces"])
    assert spark.table(names["traces"]).count() == len(before) + 2
    assert [m.day for m in S.merge_days(spark, "traces", names["traces"], date(2024, 1, 10))] == ["2024-01-02"]
    assert spark.table(names["traces"]).count() == len(before) + 2


def test_a_merge_that_stops_halfway_changes_nothing(spark, out):
    names = catalog(spark, out, "half_merged")
    rows = inputs.spans(spark, SF_SMALL).filter("EventDate = DATE'2024-01-05'")
    for _ in range(2):
        S.insert_rows(rows, "traces", names["traces"])
    before = text_rows(spark.table(names["traces"]))

    def stop():
        raise Crash

    with pytest.raises(Crash):
        S.merge_day(spark, "traces", names["traces"], "2024-01-05", 1 << 28, stop)
    assert text_rows(spark.table(names["traces"])) == before
    # files that a stream publishes between the rewrite and the swap come along
    late = lambda: S.insert_rows(rows, "traces", names["traces"])
    assert S.merge_day(spark, "traces", names["traces"], "2024-01-05", 1 << 28, late).files >= 2
    assert spark.table(names["traces"]).count() == 3 * rows.count()


def test_late_files_survive_a_call_that_ends_after_the_swap(spark, out, monkeypatch):
    names = catalog(spark, out, "ended_after_swap")
    rows = inputs.spans(spark, SF_SMALL).filter("EventDate = DATE'2024-01-05'")
    for _ in range(2):
        S.insert_rows(rows, "traces", names["traces"])

    def stop(*_):
        raise Crash

    late = lambda: S.insert_rows(rows, "traces", names["traces"])
    with monkeypatch.context() as m, pytest.raises(Crash):
        m.setattr(S, "_bring_late_files", stop)
        S.merge_day(spark, "traces", names["traces"], "2024-01-05", 1 << 28, late)
    spark.catalog.refreshTable(names["traces"])
    assert spark.table(names["traces"]).count() == 2 * rows.count()
    S.merge_days(spark, "traces", names["traces"], date(2024, 1, 10))
    assert spark.table(names["traces"]).count() == 3 * rows.count()


def test_a_stream_after_a_merge_writes_to_the_merged_day(spark, out):
    names = catalog(spark, out, "stream_after_merge")
    for n in range(2):
        source = wire.write_span_batches(spark, SF_SMALL, f"{out}/in{n}", files=1)
        stream_ingest(spark, "traces", source, f"{out}/t", f"{out}/c{n}", tables=names).awaitTermination()
    merged = S.merge_days(spark, "traces", names["traces"], date(2025, 1, 1))
    assert len(merged) == 30
    S.drop_replaced(spark, merged)
    source = wire.write_span_batches(spark, SF_SMALL, f"{out}/in2", files=1)
    stream_ingest(spark, "traces", source, f"{out}/t", f"{out}/c2", tables=names).awaitTermination()
    assert spark.table(names["traces"]).count() == 3000


def test_only_the_border_day_is_read(spark, out, monkeypatch):
    """30 days of 24 hours, one row an hour; the border day may or may not have expired."""
    start = datetime(2024, 1, 1)
    names = catalog(spark, out, "border_days")
    hours = spark.range(30 * 24).select(
        F.concat(F.lit("t"), "id").alias("TraceId"),
        F.expr(f"TIMESTAMP'{start}' + make_dt_interval(0, id)").alias("Start"),
        F.expr(f"TIMESTAMP'{start}' + make_dt_interval(0, id)").alias("End"),
    )
    read = []
    original = S.expired_partitions
    monkeypatch.setattr(S, "expired_partitions", lambda df, *a: read.append(df) or original(df, *a))
    S.write_table(hours, "lookup", f"{out}/path")
    S.insert_rows(hours, "lookup", names["lookup"])
    rng = random.Random(2)
    for _ in range(6):
        ttl = timedelta(seconds=rng.randrange(1, 20 * 86400), milliseconds=rng.randrange(1000))
        now = start + timedelta(seconds=rng.randrange(0, 40 * 86400))
        want = sorted(r[0] for r in original(spark.table(names["lookup"]), "lookup", ttl, now).select("StartDate").collect())
        read.clear()
        assert S.expired_days(spark, "lookup", names["lookup"], ttl, now) == want
        assert len(read) <= 1
        for df in read:
            filters = formatted(df).split("PartitionFilters:")[1].split("\n")[0]
            assert filters.count("2024-") == 1
    ttl, now = timedelta(days=10), datetime(2024, 1, 20, 23, 0, 0)
    want = [date(2024, 1, d) for d in range(1, 11)]  # the last row of the 10th is of 23:00
    assert S.drop_expired(spark, "lookup", names["lookup"], ttl, now) == want
    assert S.drop_expired_folders(spark, "lookup", f"{out}/path", ttl, now) == want
    assert S.drop_expired_folders(spark, "lookup", f"{out}/path", ttl, now) == []
    assert spark.table(names["lookup"]).count() == S.read_table(spark, "lookup", f"{out}/path").count() == 20 * 24
    assert S.drop_expired_folders(spark, "lookup", f"{out}/path", timedelta(0), now) == []


def test_token_lookup_prunes_days(spark, out):
    logs = inputs.logs(spark, SF_SMALL)
    S.write_logs(logs, f"{out}/logs")
    stored = S.read_table(spark, "logs", f"{out}/logs")
    for part in (0, 1):  # two batches, each with its own rows
        S.write_lookup(L.token_days(stored.filter(F.col("TimestampNanos") % 2 == part)), "token_days", f"{out}/tokens")
    lookup = S.read_table(spark, "token_days", f"{out}/tokens")
    for token in ("137", "purchase", "absent"):
        found = L.search_bodies(stored, lookup, token)
        want = L.body_has_token(stored, token)
        assert text_rows(found) == text_rows(want)
    text = plan_text(found)
    assert "dynamicpruning" in text and "BroadcastHashJoin" in text
    assert "EqualTo(Token,absent)" in formatted(found)


def test_views_see_nested_parts(spark):
    """A lost exemplar or bucket changes the view."""
    gauge = inputs.gauge(spark, SF_SMALL)
    whole = _metric_view({"gauge": gauge}).collect()
    less = _metric_view({"gauge": gauge.withColumn("Exemplars", F.slice("Exemplars", 1, 0))}).collect()
    assert whole != less


def test_files_of_a_store(spark, out):
    store = Store(spark, out)
    assert store.files(f"{out}/none") == [] and store.folders(f"{out}/none") == [] and store.note(f"{out}/none") is None
    store.write_note(f"{out}/a/n.json", {"x": 1})
    store.write_note(f"{out}/a/n.json", {"x": "ü"})
    assert store.note(f"{out}/a/n.json") == {"x": "ü"} and os.listdir(f"{out}/a") != []
    spark.range(10).coalesce(1).write.parquet(f"{out}/p")
    ((file, size),) = store.files(f"{out}/p")
    store.move(file, f"{out}/q/moved.parquet")
    store.move(file, f"{out}/q/moved.parquet")  # has ended before
    assert size > 0 and spark.read.parquet(f"{out}/q").count() == 10 and store.files(f"{out}/p") == []
    spark.range(3).coalesce(1).write.parquet(f"{out}/r")
    store.move(store.files(f"{out}/r")[0][0], f"{out}/q/moved.parquet")  # replaces what a broken move left
    assert spark.read.parquet(f"{out}/q").count() == 3
    with pytest.raises(FileNotFoundError):
        store.move(f"{out}/absent", f"{out}/q/other")


def test_bloom_filters_take_the_size_asked_for(spark, out):
    options = S.layout_options("logs", bloom_bytes=1 << 20)
    assert options["parquet.bloom.filter.max.bytes"] == str(1 << 20)
    S.write_table(inputs.logs(spark, SF_SMALL), "logs", out, options=options)
    assert S.read_table(spark, "logs", out).count() == 1000
