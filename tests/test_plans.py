"""Physical plans that must hold at any data size."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from signalbarn.operators import histograms as H
from signalbarn.operators import logs as L
from signalbarn.operators import metrics as M
from signalbarn.operators import traces as T
from signalbarn.plans import inputs
from signalbarn.plans.queries import NOW, TRACE_ID, TTL
from signalbarn.sources import tables as S
from tests.conftest import SF_SMALL, formatted, plan_text


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("plans"))
    rows = {
        "traces": inputs.spans(spark, SF_SMALL),
        "logs": inputs.logs(spark, SF_SMALL),
        "gauge": inputs.gauge(spark, SF_SMALL),
        "sum": inputs.sum_cumulative(spark, SF_SMALL),
        "histogram": inputs.histogram(spark, SF_SMALL),
        "lookup": T.trace_id_ts(inputs.spans(spark, SF_SMALL)),
    }
    for table, df in rows.items():
        S.write_table(df, table, f"{root}/{table}")
    return lambda table: S.read_table(spark, table, f"{root}/{table}")


@pytest.fixture(autouse=True)
def no_small_broadcasts(spark):
    """Small test tables must not hide the plan of large ones."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, old)


def test_scan_prunes_days_and_columns(stored):
    df = S.time_filter(stored("traces"), "traces", datetime(2024, 1, 3), datetime(2024, 1, 5))
    text = formatted(df.select("SpanId"))
    assert "EventDate" in text.split("PartitionFilters:")[1].split("\n")[0]
    assert "2024-01-03" in text and "2024-01-04" in text and "2024-01-05" not in text
    assert "ReadSchema: struct<TimestampNanos:bigint,SpanId:string>" in text


def test_scan_reads_only_the_days_asked_for(stored):
    df = S.time_filter(stored("traces"), "traces", datetime(2024, 1, 3), datetime(2024, 1, 5))
    days = {f.split("EventDate=")[1][:10] for f in df.inputFiles()}
    assert len(days) == 30  # listed before pruning
    assert {str(r[0]) for r in df.select("EventDate").distinct().collect()} == {
        "2024-01-03",
        "2024-01-04",
    }


@pytest.mark.parametrize("table", ["traces", "logs", "lookup"])
def test_trace_id_is_pushed(stored, table):
    assert f"EqualTo(TraceId,{TRACE_ID})" in formatted(T.by_trace_id(stored(table), TRACE_ID))


def test_filters_are_pushed(stored):
    assert "GreaterThanOrEqual(Duration,5)" in formatted(T.duration_between(stored("traces"), 5, 9))
    assert "GreaterThanOrEqual(SeverityNumber,13)" in formatted(L.severity_at_least(stored("logs"), 13))
    assert "Not(EqualTo(TraceId,))" in formatted(T.nonempty_trace(stored("traces")))


def test_fetch_trace_prunes_at_run_time(stored):
    df = T.fetch_trace(stored("traces"), stored("lookup"), TRACE_ID)
    text = plan_text(df)
    assert "dynamicpruning" in text
    assert "BroadcastHashJoin" in text and "NestedLoop" not in text


def operators(stored):
    spans, logs, sums = stored("traces"), stored("logs"), stored("sum")
    return {
        "parent_child": T.parent_child(spans),
        "service_edges": T.service_edges(spans),
        "links": T.links_to_spans(spans),
        "logs_left": L.logs_with_spans(logs, spans, "left"),
        "exemplars": M.exemplars_to_spans(stored("gauge"), spans),
        "operation_stats": T.operation_stats(spans, 5),
        "increase": M.counter_increase(sums),
        "cumulative": M.delta_to_cumulative(sums),
        "merge": H.merge_histograms(stored("histogram"), ["ServiceName"]),
        "expired": S.expired_partitions(spans, "traces", TTL, NOW),
        "timeline": T.trace_timeline(spans, TRACE_ID),
    }


def test_no_cross_joins_no_python(stored):
    for name, df in operators(stored).items():
        text = plan_text(df)
        assert "CartesianProduct" not in text, name
        assert "NestedLoop" not in text, name
        assert "Python" not in text and "InPandas" not in text, name
        assert "SinglePartition" not in text, name


def test_points_are_shuffled_once(stored):
    """The slice join reuses the partitioning of the slice windows."""
    df = M.counter_increase(stored("sum")).groupBy("ServiceName").agg(F.sum("Increase"))
    lines = plan_text(df).splitlines()
    points = [x for x in lines if "Exchange" in x and ":" in x.split("+-")[0]]
    assert len(points) == 1 and "_slice" in points[0]


def test_top_per_group_is_cut_before_the_shuffle(stored):
    for df in (
        M.latest_per_series(stored("gauge")),
        T.slowest_spans(stored("traces"), 5, "ServiceName"),
    ):
        text = plan_text(df)
        last = text.rindex("Exchange")
        assert "WindowGroupLimit" in text[last:]


def test_aggregates_combine_before_the_shuffle(stored):
    spans = stored("traces")
    for df in (
        T.trace_id_ts(spans),
        L.count_by(stored("logs")),
        M.metric_trend(stored("gauge"), timedelta(hours=1)),
        M.series_cardinality(stored("gauge")),
        H.merge_histograms(stored("histogram").drop("AggregationTemporality"), ["ServiceName"]),
    ):
        text = plan_text(df)
        assert "Aggregate(key" in text[text.rindex("Exchange") :]


def test_cumulative_runs_are_cut_before_the_shuffle(stored):
    """Where points may be cumulative, each task passes on one row per run."""
    for df in (
        H.merge_histograms(stored("histogram"), ["ServiceName"]),
        M.mean_from_sum_count(stored("histogram"), ["ServiceName"]),
    ):
        text = plan_text(df)
        assert "WindowGroupLimit" in text[text.rindex("Exchange") :]


def test_totals_scan_the_points_three_times(stored):
    """Deltas, cumulative points, and the tails of their slices."""
    assert plan_text(M.sum_total(stored("sum"), ["ServiceName"])).count("FileScan") <= 3


def test_edges_read_four_columns(stored):
    text = formatted(T.service_edges(stored("traces")))
    assert "ReadSchema: struct<TraceId:string,ParentSpanId:string,ServiceName:string,StatusCode:string>" in text


def test_bloom_filters_are_written_and_small(spark, stored):
    import glob

    import pyarrow.parquet as pq

    path = stored("logs").inputFiles()[0].removeprefix("file://")
    assert glob.glob(path)
    size = pq.ParquetFile(path).metadata.serialized_size
    assert size < 100_000
    options = S.layout_options("traces")
    assert options["parquet.bloom.filter.fpp#TraceId"] == "0.001"
    fixed = S.layout_options("logs", distinct_ids=1000)
    assert fixed["parquet.bloom.filter.expected.ndv#SpanId"] == "1000"
    assert "parquet.bloom.filter.adaptive.enabled" not in fixed


def test_promoted_attributes_reach_the_scan_and_keep_maps_apart(spark, out):
    from signalbarn.functions.columns import promoted_name

    rows = S.promote_attrs(inputs.logs(spark, SF_SMALL), "ResourceAttributes", ["service.name"])
    assert T.where_attr_equals(rows, "LogAttributes", "service.name", "svc-3").count() == 0
    S.write_table(rows, "logs", f"{out}/logs")
    stored = S.read_table(spark, "logs", f"{out}/logs", {"ResourceAttributes": ["service.name"]})
    found = T.where_attr_equals(stored, "ResourceAttributes", "service.name", "svc-3")
    assert f"EqualTo({promoted_name('ResourceAttributes', 'service.name')},svc-3)" in formatted(found)
    assert found.count() > 0
    assert promoted_name("a", "b.c") != promoted_name("a", "b_2e_c")
