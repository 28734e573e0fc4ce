"""SQL counterparts of the registered queries, for DuckDB on the same tables."""

from __future__ import annotations

from signalbarn.plans.inputs import BOUNDS
from signalbarn.plans.queries import SLA_NANOS, SPAN_ID, TOKEN, TRACE_ID

_DAY_NS = 86_400_000_000_000

# Derived inputs as common table expressions: name -> (inputs it reads, SQL).
_CTES: dict[str, tuple[list[str], str]] = {
    "ev": (
        [],
        """
        SELECT event_id, user_id, event_type,
               CAST(round(value * 100) AS BIGINT) AS cents,
               'svc-' || CAST(user_id % 8 AS VARCHAR) AS svc,
               CAST(ts AS DATE) AS d,
               json_extract_string(props, '$.k') AS k,
               epoch_us(ts) * 1000 + event_id % 1000 AS nanos,
               CAST(epoch_us(CAST(CAST(ts AS DATE) AS TIMESTAMP)) * 1000 AS BIGINT) AS midnight
        FROM events
        """,
    ),
    "spans": (
        ["ev"],
        """
        SELECT md5('t' || CAST(event_id // 5 AS VARCHAR)) AS TraceId,
               substr(md5('s' || CAST(event_id AS VARCHAR)), 1, 16) AS SpanId,
               CASE WHEN event_id % 5 = 0 THEN ''
                    ELSE substr(md5('s' || CAST(event_id - event_id % 5
                                + (event_id % 5 - 1) // 2 AS VARCHAR)), 1, 16)
               END AS ParentSpanId,
               event_type AS SpanName,
               CASE event_type WHEN 'view' THEN 'Server' WHEN 'click' THEN 'Client'
                    ELSE 'Internal' END AS SpanKind,
               svc AS ServiceName,
               nanos AS TimestampNanos,
               cents * 10000 AS Duration,
               CASE event_type WHEN 'error' THEN 'Error' WHEN 'purchase' THEN 'Ok'
                    ELSE 'Unset' END AS StatusCode,
               k,
               CASE WHEN event_type = 'error' THEN 'exception' ELSE '' END AS event_name,
               CASE WHEN event_type = 'error' THEN 'E' || k ELSE '' END AS exception_type,
               CASE WHEN event_id % 7 = 0 AND event_id >= 5
                    THEN md5('t' || CAST((event_id - 5) // 5 AS VARCHAR)) ELSE '' END AS link_trace,
               CASE WHEN event_id % 7 = 0 AND event_id >= 5
                    THEN substr(md5('s' || CAST(event_id - 5 AS VARCHAR)), 1, 16)
                    ELSE '' END AS link_span,
               d
        FROM ev
        """,
    ),
    "logs": (
        ["ev"],
        """
        SELECT CASE WHEN event_id % 10 = 0 THEN ''
                    ELSE md5('t' || CAST(event_id // 5 AS VARCHAR)) END AS TraceId,
               CASE WHEN event_id % 10 = 0 THEN ''
                    ELSE substr(md5('s' || CAST(event_id AS VARCHAR)), 1, 16) END AS SpanId,
               nanos AS TimestampNanos,
               nanos + (user_id % 5) * 1000000000 AS ObservedTimestampNanos,
               CASE event_type WHEN 'error' THEN 'ERROR' WHEN 'view' THEN 'WARN'
                    WHEN 'click' THEN 'DEBUG' ELSE 'INFO' END AS SeverityText,
               CAST(CASE event_type WHEN 'error' THEN 17 WHEN 'view' THEN 13
                    WHEN 'click' THEN 5 ELSE 9 END AS INTEGER) AS SeverityNumber,
               svc AS ServiceName,
               '1.' || CAST(user_id % 3 AS VARCHAR) AS ServiceVersion,
               'event_' || event_type || ' user=' || CAST(user_id AS VARCHAR) || ' cents='
                   || CAST(cents AS VARCHAR) || ' k=' || k AS Body,
               event_type, k, svc AS resource_service, event_id
        FROM ev
        """,
    ),
    "hist": (
        ["ev"],
        f"""
        SELECT svc, event_type, d, midnight, count(*) AS n, CAST(sum(cents) AS BIGINT) AS total,
               min(cents) AS low, max(cents) AS high,
               {", ".join(
                   f"count(*) FILTER (WHERE {cond}) AS b{i}"
                   for i, cond in enumerate(
                       [f"cents <= {BOUNDS[0]}"]
                       + [f"cents > {a} AND cents <= {b}" for a, b in zip(BOUNDS, BOUNDS[1:])]
                       + [f"cents > {BOUNDS[-1]}"]
                   )
               )}
        FROM ev GROUP BY ALL
        """,
    ),
    "expo": (
        ["ev"],
        """
        SELECT svc, d, midnight, cents,
               CASE WHEN cents <= 1 THEN -1 ELSE length(bin(cents - 1)) - 1 END AS idx
        FROM ev
        """,
    ),
    "summ": (
        ["ev"],
        """
        SELECT svc, d, midnight, count(*) AS n, CAST(sum(cents) AS BIGINT) AS total,
               quantile_disc(cents, 0.5) AS q50, quantile_disc(cents, 0.9) AS q90,
               quantile_disc(cents, 0.99) AS q99
        FROM ev GROUP BY ALL
        """,
    ),
    "running": (
        ["ev"],
        """
        SELECT svc, d, nanos, cents,
               CAST(sum(cents) OVER (PARTITION BY svc, d ORDER BY nanos
                    ROWS UNBOUNDED PRECEDING) AS BIGINT) AS value
        FROM ev
        """,
    ),
    "grown": (
        ["running"],
        """
        SELECT svc, nanos,
               lag(nanos) OVER w AS before,
               CASE WHEN lag(nanos) OVER w IS NULL THEN 0
                    WHEN lag(d) OVER w <> d THEN value
                    ELSE value - lag(value) OVER w END AS increase
        FROM running
        WINDOW w AS (PARTITION BY svc ORDER BY nanos)
        """,
    ),
}


def _with(needs: list[str], body: str) -> str:
    order: list[str] = []

    def add(name: str) -> None:
        for dep in _CTES[name][0]:
            add(dep)
        if name not in order:
            order.append(name)

    for name in needs:
        add(name)
    ctes = ", ".join(f"{name} AS ({_CTES[name][1].strip()})" for name in order)
    # A body that starts with a comma adds common table expressions of its own.
    return f"WITH {ctes} {body.strip()}"


_LOG_COLUMNS = (
    "TraceId, SpanId, TimestampNanos, ObservedTimestampNanos, SeverityText, SeverityNumber, "
    "ServiceName, ServiceVersion, Body"
)
_LOGS = _with(["logs"], f"SELECT {_LOG_COLUMNS}, event_type, k, resource_service FROM logs")
_SPAN_COLUMNS = (
    "TraceId, SpanId, ParentSpanId, SpanName, SpanKind, ServiceName, TimestampNanos, Duration, "
    "StatusCode, k, event_name, exception_type, link_trace, link_span"
)
_SPANS = _with(["spans"], f"SELECT {_SPAN_COLUMNS} FROM spans")

def _texts(*parts: str) -> str:
    return " || ',' || ".join(f"CAST(CAST({p} AS BIGINT) AS VARCHAR)" for p in parts)


_METRICS = _with(
    ["ev", "hist", "summ", "expo"],
    f"""
    , per_day AS (
        SELECT svc, d, sum(cents) AS total, count(*) AS n, min(idx) AS lo, max(idx) AS hi
        FROM expo GROUP BY svc, d
    )
    SELECT 'gauge' AS table_name, svc AS ServiceName, count(*) AS points,
           CAST(sum(cents) AS BIGINT) AS total, count(DISTINCT event_type) AS series,
           {_texts("count(*)", "sum(cents)", "count(*)")} AS nested
    FROM ev GROUP BY svc
    UNION ALL
    SELECT 'sum', svc, count(*), CAST(sum(cents) AS BIGINT), 1, {_texts("count(*)", "1")}
    FROM ev GROUP BY svc
    UNION ALL
    SELECT 'histogram', svc, count(*), CAST(sum(total) AS BIGINT), count(DISTINCT event_type),
           {_texts(*[f"sum(b{i})" for i in range(len(BOUNDS) + 1)], f"{sum(BOUNDS)} * count(*)")}
    FROM hist GROUP BY svc
    UNION ALL
    SELECT 'exponential_histogram', svc, count(*), CAST(sum(total) AS BIGINT), 1,
           {_texts("sum(lo)", "sum(hi - lo + 1)", "sum(n)", "0")}
    FROM per_day GROUP BY svc
    UNION ALL
    SELECT 'summary', svc, count(*), CAST(sum(total) AS BIGINT), 1,
           {_texts("sum(q50)", "sum(q90)", "sum(q99)")}
    FROM summ GROUP BY svc
    """,
)

# Damaged batches: lines cut off, integers too large and histograms with a bucket missing.
_READ, _LARGE, _SHORT = "(event_id // 40) % 5 <> 3", "event_id % 11 = 4", "event_id % 13 = 5"
_LINES = "count(DISTINCT event_id // 40) FILTER (NOT " + _READ + ")"


def _stored(signal: str, table: str, measure: str, unfit: str) -> str:
    return f"""
        SELECT '{signal}' AS signal, 'row' AS outcome, '{table}' AS table_name,
               count(*) AS records, CAST(sum({measure}) AS BIGINT) AS total
        FROM ev WHERE {_READ} AND NOT ({unfit})
    """


def _rejected(signal: str, level: str, counted: str) -> str:
    return f"""
        SELECT '{signal}', '{level}', 'none', CAST({counted} AS BIGINT), CAST({counted} AS BIGINT) FROM ev
    """


_SEVERITY = "CASE event_type WHEN 'error' THEN 17 WHEN 'view' THEN 13 WHEN 'click' THEN 5 ELSE 9 END"
_INGESTED = _with(
    ["ev"],
    " UNION ALL ".join(
        [
            _stored("logs", "logs", _SEVERITY, _LARGE),
            _rejected("logs", "record", f"count(*) FILTER ({_READ} AND {_LARGE})"),
            _rejected("logs", "line", _LINES),
            _stored("traces", "traces", "cents * 10000", _LARGE),
            _rejected("traces", "record", f"count(*) FILTER ({_READ} AND {_LARGE})"),
            _rejected("traces", "line", _LINES),
            _stored("metrics", "gauge", "cents", "false"),
            _stored("metrics", "sum", "cents", _LARGE),
            _stored("metrics", "histogram", "cents", _SHORT),
            _rejected(
                "metrics",
                "point",
                f"count(*) FILTER ({_READ} AND {_LARGE}) + count(*) FILTER ({_READ} AND {_SHORT})",
            ),
            _rejected("metrics", "line", _LINES),
        ]
    ),
)

_LOOKUP = _with(
    ["spans"],
    """
    SELECT TraceId, min(TimestampNanos) // 1000000000 AS start_s,
           max(TimestampNanos) // 1000000000 AS end_s
    FROM spans WHERE TraceId <> '' GROUP BY TraceId
    """,
)

_JAN_5, _JAN_20 = 1_704_412_800_000_000_000, 1_705_708_800_000_000_000
_EDGES = "[" + ", ".join(str(b) for b in BOUNDS) + "]"
_BUCKETS = "[" + ", ".join(f"b{i}" for i in range(len(BOUNDS) + 1)) + "]"
_BUCKET_SUMS = " || ',' || ".join(
    f"CAST(CAST(sum(b{i}) AS BIGINT) AS VARCHAR)" for i in range(len(BOUNDS) + 1)
)

ORACLE_SQL: dict[str, str] = {
    "otlp_logs": _LOGS,
    "otlp_traces": _SPANS,
    "otlp_metrics": _METRICS,
    "scan_day_range": _with(
        ["spans"],
        """
        SELECT TraceId, SpanId, TimestampNanos, CAST(d AS VARCHAR) AS EventDate FROM spans
        WHERE TimestampNanos >= epoch_us(TIMESTAMP '2024-01-10 06:00:00') * 1000
          AND TimestampNanos < epoch_us(TIMESTAMP '2024-01-12 18:00:00') * 1000
        """,
    ),
    "roundtrip_logs": _LOGS,
    "roundtrip_traces": _SPANS,
    "route_metrics": _METRICS,
    "roundtrip_lookup": _LOOKUP,
    "ingest_rejects": _INGESTED,
    "ensure_tables": _with(
        ["spans", "hist", "summ"],
        """
        , lookup AS (SELECT min(TimestampNanos) // 86400000000000 AS day FROM spans GROUP BY TraceId)
        SELECT 'otel_logs' AS table_name, count(*) AS rows_stored, count(DISTINCT d) AS days FROM ev
        UNION ALL SELECT 'otel_traces', count(*), count(DISTINCT d) FROM ev
        UNION ALL SELECT 'otel_traces_trace_id_ts', count(*), count(DISTINCT day) FROM lookup
        UNION ALL SELECT 'otel_metrics_gauge', count(*), count(DISTINCT d) FROM ev
        UNION ALL SELECT 'otel_metrics_sum', count(*), count(DISTINCT d) FROM ev
        UNION ALL SELECT 'otel_metrics_histogram', count(*), count(DISTINCT d) FROM hist
        UNION ALL SELECT 'otel_metrics_exponential_histogram', count(*), count(DISTINCT d) FROM summ
        UNION ALL SELECT 'otel_metrics_summary', count(*), count(DISTINCT d) FROM summ
        """,
    ),
    "log_detail": _with(
        ["logs"],
        "SELECT SeverityText AS severity, Body AS body, TimestampNanos AS timestamp_nanos FROM logs",
    ),
    "span_detail": _with(
        ["spans"],
        """
        SELECT SpanId AS span_id, TraceId AS trace_id, SpanName AS name, SpanKind AS kind,
               Duration AS duration FROM spans
        """,
    ),
    "metric_detail": _with(
        ["ev", "hist", "summ"],
        """
        SELECT 'event.value' AS name, '' AS description, 'cents' AS unit, 'Gauge' AS type,
               count(*) AS metrics FROM ev
        UNION ALL SELECT 'event.cents', '', 'cents', 'Sum', count(*) FROM ev
        UNION ALL SELECT 'event.cents.hist', '', 'cents', 'Histogram', count(*) FROM hist
        UNION ALL SELECT 'event.cents.exp', '', 'cents', 'ExponentialHistogram', count(*) FROM summ
        UNION ALL SELECT 'event.cents.summary', '', 'cents', 'Summary', count(*) FROM summ
        """,
    ),
    "attrs_to_map": _with(
        ["logs"],
        """
        SELECT TimestampNanos, event_type, k,
               CASE WHEN event_id % 10 = 0 THEN 'true' ELSE 'false' END AS bare,
               '' AS missing, CAST(3 AS INTEGER) AS keys
        FROM logs
        """,
    ),
    "promote_service": _with(
        ["logs"], "SELECT TimestampNanos, ServiceName, ServiceVersion FROM logs"
    ),
    "span_events": _with(
        ["spans"],
        """
        SELECT TraceId, SpanId, SpanName, TimestampNanos AS EventTimestampNanos,
               event_name AS EventName, exception_type
        FROM spans WHERE event_name <> ''
        """,
    ),
    "span_links": _with(
        ["spans"],
        """
        SELECT TraceId, SpanId, link_trace AS LinkTraceId, link_span AS LinkSpanId
        FROM spans WHERE link_span <> ''
        """,
    ),
    "exemplars": _with(
        ["spans"],
        """
        SELECT ServiceName, TimestampNanos AS TimeUnixNanos, TraceId, SpanId,
               Duration // 10000 AS value, k FROM spans
        """,
    ),
    "exemplars_all_types": _with(
        ["ev", "hist", "summ"],
        f"""
        , told AS (
            SELECT svc, d, nanos AS ExemplarTimeNanos, md5('t' || CAST(event_id // 5 AS VARCHAR)) AS TraceId,
                   substr(md5('s' || CAST(event_id AS VARCHAR)), 1, 16) AS SpanId, cents AS value, k,
                   row_number() OVER (PARTITION BY svc, d ORDER BY event_id) AS r
            FROM ev
        )
        SELECT 'gauge' AS table_name, svc AS ServiceName, ExemplarTimeNanos AS TimeUnixNanos,
               ExemplarTimeNanos, TraceId, SpanId, value, k FROM told
        UNION ALL
        SELECT 'sum', svc, ExemplarTimeNanos, ExemplarTimeNanos, TraceId, SpanId, value, k FROM told
        UNION ALL
        SELECT 'histogram', svc, midnight + {_DAY_NS} - 1, ExemplarTimeNanos, TraceId, SpanId, value, k
        FROM hist JOIN told USING (svc, d) WHERE r = 1
        UNION ALL
        SELECT 'exponential_histogram', svc, midnight + {_DAY_NS} - 1, ExemplarTimeNanos, TraceId, SpanId, value, k
        FROM summ JOIN told USING (svc, d) WHERE r = 1
        """,
    ),
    "summary_quantiles": _with(
        ["summ"],
        "\nUNION ALL\n".join(
            f"""
            SELECT svc AS ServiceName, midnight + {_DAY_NS} - 1 AS TimeUnixNanos, n AS Count,
                   total, CAST({q} AS DOUBLE) AS Quantile, {c} AS value FROM summ
            """
            for q, c in ((0.5, "q50"), (0.9, "q90"), (0.99, "q99"))
        ),
    ),
    "nested_arrays": _with(
        ["spans"],
        """
        SELECT SpanId, event_name AS event_names,
               CAST(CASE WHEN event_name <> '' THEN 1 ELSE 0 END AS INTEGER) AS events,
               CAST(CASE WHEN link_span <> '' THEN 1 ELSE 0 END AS INTEGER) AS links,
               CASE WHEN event_name <> '' THEN TimestampNanos ELSE 0 END AS event_nanos,
               link_span
        FROM spans
        """,
    ),
    "collection_lag": _with(
        ["logs"],
        """
        SELECT TimestampNanos, ObservedTimestampNanos - TimestampNanos AS LagNanos FROM logs
        """,
    ),
    "nonempty_trace": _with(
        ["logs"], "SELECT TraceId, TimestampNanos FROM logs WHERE TraceId <> ''"
    ),
    "by_trace_id": _with(
        ["spans", "logs"],
        f"""
        SELECT 'span' AS signal, TraceId, SpanId FROM spans WHERE TraceId = '{TRACE_ID}'
        UNION ALL
        SELECT 'log', TraceId, SpanId FROM logs WHERE TraceId = '{TRACE_ID}'
        """,
    ),
    "by_span_id": _with(
        ["logs"], f"SELECT {_LOG_COLUMNS} FROM logs WHERE SpanId = '{SPAN_ID}'"
    ),
    "has_attr_key": _with(
        ["ev"],
        """
        SELECT 'logs' AS source, true AS has_k, false AS has_absent, count(*) AS n FROM ev
        UNION ALL
        SELECT 'events', true, false, count(*) FROM ev WHERE event_type = 'error'
        """,
    ),
    "has_attr_value": _with(
        ["logs"],
        """
        SELECT TimestampNanos, ServiceName, k FROM logs WHERE k = '42' OR event_type = '42'
        """,
    ),
    "attr_equals": _with(
        ["logs"],
        "SELECT TimestampNanos, ServiceName, Body FROM logs WHERE resource_service = 'svc-3'",
    ),
    "promoted_attr": _with(
        ["logs"],
        "SELECT TimestampNanos, ServiceName, coalesce(k, '') AS k FROM logs "
        f"WHERE resource_service = 'svc-3' AND TimestampNanos >= {_JAN_5} AND TimestampNanos < {_JAN_20}",
    ),
    "duration_between": _with(
        ["spans"],
        "SELECT SpanId, Duration FROM spans WHERE Duration BETWEEN 10000000 AND 20000000",
    ),
    "severity_at_least": _with(
        ["logs"],
        """
        SELECT TimestampNanos, SeverityNumber, SeverityText FROM logs WHERE SeverityNumber >= 13
        """,
    ),
    "logs_for": _with(
        ["logs"],
        f"""
        SELECT {_LOG_COLUMNS} FROM logs
        WHERE ServiceName = 'svc-2' AND SeverityNumber >= 9
          AND TimestampNanos >= {_JAN_5} AND TimestampNanos < {_JAN_20}
        """,
    ),
    "series_for": _with(
        ["ev"],
        f"""
        SELECT svc AS ServiceName, nanos AS TimeUnixNanos, cents AS value FROM ev
        WHERE svc = 'svc-1' AND event_type = 'purchase'
          AND nanos >= {_JAN_5} AND nanos < {_JAN_20}
        """,
    ),
    "spans_for": _with(
        ["spans"],
        f"""
        SELECT TraceId, SpanId, TimestampNanos FROM spans
        WHERE ServiceName = 'svc-4' AND SpanName = 'click'
          AND TimestampNanos >= {_JAN_5} AND TimestampNanos < {_JAN_20}
        """,
    ),
    "body_has_token": r"""
        SELECT doc_id, source AS ServiceName,
               1704067200000000000 + doc_id * 60000000000 AS TimestampNanos
        FROM documents
        WHERE list_contains(
            regexp_split_to_array(text, '[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'), 'thatin')
    """.strip(),
    "token_days": _with(
        ["logs"],
        rf"""
        SELECT TimestampNanos, ServiceName, Body,
               strftime(make_timestamp(TimestampNanos // 1000), '%Y-%m-%d') AS EventDate
        FROM logs
        WHERE list_contains(
            regexp_split_to_array(Body, '[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'), '{TOKEN}')
        """,
    ),
    "error_spans": _with(
        ["spans"],
        "SELECT TraceId, SpanId, StatusCode FROM spans WHERE upper(StatusCode) = 'ERROR'",
    ),
    "fetch_trace": _with(
        ["spans"], f"SELECT {_SPAN_COLUMNS} FROM spans WHERE TraceId = '{TRACE_ID}'"
    ),
    "logs_spans_inner": _with(
        ["logs", "spans"],
        """
        SELECT l.TraceId, l.SpanId, l.Body, s.SpanName, s.ServiceName AS SpanService, s.Duration
        FROM logs l JOIN spans s ON l.TraceId = s.TraceId AND l.SpanId = s.SpanId
        WHERE l.TraceId <> '' AND l.SpanId <> ''
        """,
    ),
    "logs_spans_left": _with(
        ["logs", "spans"],
        """
        SELECT l.TraceId, l.SpanId, l.Body, s.SpanName, s.ServiceName AS SpanService, s.Duration
        FROM logs l LEFT JOIN spans s
          ON l.TraceId = s.TraceId AND l.SpanId = s.SpanId AND l.TraceId <> '' AND l.SpanId <> ''
        """,
    ),
    "logs_spans_semi": _with(
        ["logs", "spans"],
        """
        SELECT TraceId, SpanId, Body FROM logs l
        WHERE EXISTS (SELECT 1 FROM spans s WHERE s.TraceId = l.TraceId AND s.SpanId = l.SpanId
                      AND s.StatusCode = 'Error')
        """,
    ),
    "logs_spans_anti": _with(
        ["logs", "spans"],
        """
        SELECT TraceId, SpanId, Body FROM logs l
        WHERE NOT EXISTS (SELECT 1 FROM spans s WHERE s.TraceId = l.TraceId
                          AND s.SpanId = l.SpanId AND s.StatusCode = 'Error')
        """,
    ),
    "exemplar_spans": _with(
        ["spans"],
        """
        SELECT g.TraceId, g.SpanId, g.Duration // 10000 AS value, s.SpanName,
               s.ServiceName AS SpanService, s.Duration
        FROM spans g JOIN spans s ON g.TraceId = s.TraceId AND g.SpanId = s.SpanId
        """,
    ),
    "link_targets": _with(
        ["spans"],
        """
        SELECT l.TraceId, l.SpanId, l.link_trace AS LinkTraceId, l.link_span AS LinkSpanId,
               s.ServiceName AS TargetService, s.SpanName AS TargetName,
               s.TimestampNanos AS TargetTimestampNanos
        FROM spans l JOIN spans s ON s.TraceId = l.link_trace AND s.SpanId = l.link_span
        WHERE l.link_span <> ''
        """,
    ),
    "parent_child": _with(
        ["spans"],
        """
        SELECT c.TraceId, c.SpanId, c.ServiceName, c.SpanName,
               p.ServiceName AS ParentService, p.SpanName AS ParentName
        FROM spans c LEFT JOIN spans p
          ON p.TraceId = c.TraceId AND p.SpanId = c.ParentSpanId AND c.ParentSpanId <> ''
        """,
    ),
    "service_edges": _with(
        ["spans"],
        """
        SELECT p.ServiceName AS caller, c.ServiceName AS callee, count(*) AS calls,
               count(*) FILTER (WHERE c.StatusCode = 'Error') AS errors
        FROM spans c JOIN spans p ON p.TraceId = c.TraceId AND p.SpanId = c.ParentSpanId
        WHERE c.ParentSpanId <> '' GROUP BY p.ServiceName, c.ServiceName
        """,
    ),
    "trace_id_ts": _LOOKUP,
    "batch_summary": _with(
        ["ev", "hist", "summ"],
        """
        , per_batch AS (
            SELECT 'logs' AS signal, count(DISTINCT svc || '/' || CAST(user_id % 3 AS VARCHAR))
                   AS resource_count, count(*) AS record_count
            FROM ev GROUP BY event_id // 40
            UNION ALL
            SELECT 'traces', count(DISTINCT svc), count(*) FROM ev GROUP BY event_id // 40
            UNION ALL SELECT 'metrics', 1, 1 FROM ev
            UNION ALL SELECT 'metrics', 1, 1 FROM ev
            UNION ALL SELECT 'metrics', 1, 1 FROM hist
            UNION ALL SELECT 'metrics', 1, 1 FROM summ
            UNION ALL SELECT 'metrics', 1, 1 FROM summ
        )
        SELECT signal, resource_count, record_count, count(*) AS batches
        FROM per_batch GROUP BY ALL
        """,
    ),
    "dist_mean": _with(
        ["ev"],
        """
        SELECT svc AS ServiceName, 'event.cents.hist' AS MetricName,
               round(sum(cents) / count(*), 4) AS mean
        FROM ev GROUP BY svc
        """,
    ),
    "merge_histograms": _with(
        ["hist"],
        f"""
        SELECT svc AS ServiceName, CAST(sum(n) AS BIGINT) AS Count,
               CAST(sum(total) AS BIGINT) AS total, min(low) AS low, max(high) AS high,
               {_BUCKET_SUMS} AS buckets, '{",".join(str(b) for b in BOUNDS)}' AS bounds
        FROM hist GROUP BY svc
        """,
    ),
    "merge_histograms_cumulative": _with(
        ["hist"],
        f"""
        SELECT svc AS ServiceName, CAST(sum(n) AS BIGINT) AS Count,
               CAST(sum(total) AS BIGINT) AS total,
               {_BUCKET_SUMS} AS buckets, '{",".join(str(b) for b in BOUNDS)}' AS bounds
        FROM hist GROUP BY svc
        """,
    ),
    "dist_mean_cumulative": _with(
        ["ev"],
        """
        SELECT svc AS ServiceName, 'event.cents.hist' AS MetricName,
               round(sum(cents) / count(*), 4) AS mean
        FROM ev GROUP BY svc
        """,
    ),
    "histogram_quantile": _with(
        ["hist"],
        f"""
        , b AS (
            SELECT svc, event_type, midnight, n AS total, 0.9 * n AS want, i,
                   {_BUCKETS}[i + 1] AS n, {_EDGES} AS edges
            FROM hist, range(0, {len(BOUNDS) + 1}) AS r(i)
        ), c AS (
            SELECT *, sum(n) OVER (PARTITION BY svc, event_type, midnight ORDER BY i) AS upto
            FROM b
        ), hit AS (
            SELECT *, row_number() OVER (PARTITION BY svc, event_type, midnight ORDER BY i) AS r
            FROM c WHERE n > 0 AND CAST(upto AS DOUBLE) >= CAST(want AS DOUBLE)
        )
        SELECT svc AS ServiceName, event_type, midnight + {_DAY_NS} - 1 AS TimeUnixNanos,
               round(CASE WHEN i = {len(BOUNDS)} THEN CAST({BOUNDS[-1]} AS DOUBLE)
                    ELSE (CASE WHEN i = 0 THEN 0 ELSE edges[i] END)
                         + (edges[i + 1] - (CASE WHEN i = 0 THEN 0 ELSE edges[i] END))
                         * (CAST(want AS DOUBLE) - CAST(upto - n AS DOUBLE)) / CAST(n AS DOUBLE)
               END, 4) AS p90
        FROM hit WHERE r = 1
        """,
    ),
    "exp_buckets": _with(
        ["expo"],
        f"""
        SELECT svc AS ServiceName, midnight + {_DAY_NS} - 1 AS TimeUnixNanos,
               pow(2.0, idx) AS lower, pow(2.0, idx + 1) AS upper, count(*) AS count
        FROM expo GROUP BY svc, midnight, idx
        """,
    ),
    "merge_exp_histograms": _with(
        ["expo"],
        """
        , counts AS (
            SELECT svc, CAST(floor(idx / 2.0) AS BIGINT) AS i, count(*) AS n
            FROM expo GROUP BY ALL
        ), ends AS (
            SELECT svc, min(i) AS lo, max(i) AS hi FROM counts GROUP BY svc
        ), dense AS (
            SELECT e.svc, g.i, coalesce(c.n, 0) AS n
            FROM ends e, LATERAL (SELECT unnest(range(e.lo, e.hi + 1)) AS i) g
            LEFT JOIN counts c ON c.svc = e.svc AND c.i = g.i
        ), texts AS (
            SELECT svc, min(i) AS lo, string_agg(CAST(n AS VARCHAR), ',' ORDER BY i) AS buckets
            FROM dense GROUP BY svc
        ), stats AS (
            SELECT svc, count(*) AS n, CAST(sum(cents) AS BIGINT) AS total, min(cents) AS low,
                   max(cents) AS high FROM expo GROUP BY svc
        )
        SELECT s.svc AS ServiceName, CAST(-1 AS INTEGER) AS Scale, s.n AS Count, s.total, s.low,
               s.high, CAST(t.lo AS INTEGER) AS PositiveOffset, t.buckets
        FROM stats s JOIN texts t USING (svc)
        """,
    ),
    "exp_quantile": _with(
        ["expo"],
        f"""
        , counts AS (
            SELECT svc, midnight, idx, count(*) AS n FROM expo GROUP BY ALL
        ), placed AS (
            SELECT svc, midnight, idx,
                   sum(n) OVER (PARTITION BY svc, midnight ORDER BY idx) AS upto,
                   sum(n) OVER (PARTITION BY svc, midnight) AS total
            FROM counts
        )
        SELECT svc AS ServiceName, midnight + {_DAY_NS} - 1 AS TimeUnixNanos,
               round(pow(2.0, min(idx) + 0.5), 6) AS p90
        FROM placed WHERE CAST(upto AS DOUBLE) >= CAST(0.9 AS DOUBLE) * CAST(total AS DOUBLE)
        GROUP BY svc, midnight
        """,
    ),
    "logs_by_severity": _with(
        ["logs"],
        """
        SELECT ServiceName, ServiceVersion, SeverityText, SeverityNumber, count(*) AS logs
        FROM logs GROUP BY ALL
        """,
    ),
    "operation_stats": _with(
        ["spans"],
        f"""
        SELECT ServiceName, SpanName, count(*) AS spans,
               count(*) FILTER (WHERE StatusCode = 'Error') AS errors,
               min(Duration) AS min_duration,
               round(CAST(sum(Duration) AS DOUBLE) / count(*), 2) AS avg_duration,
               max(Duration) AS max_duration,
               quantile_disc(Duration, 0.5) AS p50, quantile_disc(Duration, 0.95) AS p95,
               quantile_disc(Duration, 0.99) AS p99,
               round(count(*) FILTER (WHERE Duration > {SLA_NANOS}) / count(*), 6)
                   AS over_sla_share
        FROM spans GROUP BY ServiceName, SpanName
        """,
    ),
    "trace_stats": _with(
        ["spans"],
        """
        , roots AS (
            SELECT TraceId, SpanId, SpanName, ServiceName,
                   row_number() OVER (PARTITION BY TraceId ORDER BY TimestampNanos, SpanId) AS r
            FROM spans WHERE ParentSpanId = ''
        ), stats AS (
            SELECT TraceId, count(*) AS spans, count(DISTINCT ServiceName) AS services,
                   count(*) FILTER (WHERE StatusCode = 'Error') AS errors,
                   min(TimestampNanos) AS first_start, max(TimestampNanos + Duration) AS last_end
            FROM spans GROUP BY TraceId
        )
        SELECT s.TraceId, spans, services, errors, first_start, last_end,
               last_end - first_start AS wall_time, r.SpanId AS root_span_id,
               r.SpanName AS root_name, r.ServiceName AS root_service
        FROM stats s LEFT JOIN roots r ON r.TraceId = s.TraceId AND r.r = 1
        """,
    ),
    "series_cardinality": _with(
        ["ev"],
        """
        SELECT svc AS ServiceName, 'event.value' AS MetricName,
               count(DISTINCT event_type) AS series FROM ev GROUP BY svc
        """,
    ),
    "series_sketch": _with(
        ["ev"],
        """
        SELECT 'all' AS days, svc AS ServiceName, count(DISTINCT (user_id, k)) AS exact,
               true AS is_close, true AS same_as_rebuilt
        FROM ev GROUP BY svc
        UNION ALL
        SELECT 'early', svc, count(DISTINCT (user_id, k)), true, true
        FROM ev WHERE d < DATE '2024-01-16' GROUP BY svc
        """,
    ),
    "metric_trend": _with(
        ["ev"],
        """
        SELECT svc AS ServiceName, '{"event_type":"' || event_type || '"}' AS SeriesKey,
               nanos // 21600000000000 * 21600000000000 AS BucketNanos, count(*) AS count,
               CAST(sum(cents) AS BIGINT) AS sum, min(cents) AS min, max(cents) AS max,
               round(CAST(sum(cents) AS DOUBLE) / count(*), 4) AS avg,
               arg_max(cents, nanos) AS last
        FROM ev GROUP BY svc, event_type, nanos // 21600000000000
        """,
    ),
    "summary_sla": _with(
        ["summ"],
        f"""
        SELECT svc AS ServiceName, midnight + {_DAY_NS} - 1 AS TimeUnixNanos, q99 AS p99,
               q99 <= 20000 AS meets_sla FROM summ
        """,
    ),
    "sum_total": _with(
        ["ev", "grown"],
        """
        SELECT svc AS ServiceName, CAST(1 AS INTEGER) AS AggregationTemporality,
               CAST(sum(cents) AS BIGINT) AS total FROM ev GROUP BY svc
        UNION ALL
        SELECT svc, CAST(2 AS INTEGER), CAST(sum(increase) AS BIGINT) FROM grown GROUP BY svc
        """,
    ),
    "sum_total_nonmonotonic": _with(
        ["running"],
        """
        , up_down AS (
            SELECT svc, nanos, d, value % 1000 AS v FROM running WHERE nanos % 11 <> 0
        ), change AS (
            SELECT svc, CASE WHEN lag(v) OVER w IS NULL THEN 0
                             WHEN lag(d) OVER w <> d THEN v
                             ELSE v - lag(v) OVER w END AS change
            FROM up_down WINDOW w AS (PARTITION BY svc ORDER BY nanos)
        )
        SELECT r.svc AS ServiceName,
               (SELECT CAST(sum(change) AS BIGINT) FROM change c WHERE c.svc = r.svc) AS total,
               CAST(count(*) FILTER (nanos % 11 = 0) AS BIGINT) AS unspecified
        FROM running r GROUP BY r.svc
        """,
    ),
    "counter_gaps": _with(
        ["running"],
        """
        SELECT svc AS ServiceName, nanos AS TimeUnixNanos,
               CASE WHEN lag(value) OVER w IS NULL THEN 0
                    WHEN lag(d) OVER w <> d THEN value
                    ELSE value - lag(value) OVER w END AS increase
        FROM running WHERE nanos % 7 <> 0
        WINDOW w AS (PARTITION BY svc ORDER BY nanos)
        """,
    ),
    "counter_increase": _with(
        ["grown"],
        "SELECT svc AS ServiceName, nanos AS TimeUnixNanos, increase FROM grown",
    ),
    "counter_rate": _with(
        ["grown"],
        """
        SELECT svc AS ServiceName, nanos AS TimeUnixNanos,
               round(CAST(increase AS DOUBLE)
                     / (CAST(nanos - before AS DOUBLE) / 1000000000.0), 6) AS rate
        FROM grown
        """,
    ),
    "to_cumulative": _with(
        ["ev"],
        """
        SELECT svc AS ServiceName, nanos AS TimeUnixNanos,
               min(midnight) OVER (PARTITION BY svc) AS StartTimeUnixNanos,
               CAST(sum(cents) OVER (PARTITION BY svc ORDER BY nanos
                    ROWS UNBOUNDED PRECEDING) AS BIGINT) AS value
        FROM ev
        """,
    ),
    "to_delta": _with(
        ["ev"],
        "SELECT svc AS ServiceName, nanos AS TimeUnixNanos, cents AS value FROM ev",
    ),
    "latest_gauge": _with(
        ["ev"],
        """
        SELECT svc AS ServiceName, '{"event_type":"' || event_type || '"}' AS SeriesKey,
               max(nanos) AS TimeUnixNanos, arg_max(cents, nanos) AS value
        FROM ev GROUP BY svc, event_type
        """,
    ),
    "histogram_delta": _with(
        ["hist"],
        f"""
        , numbered AS (
            SELECT *, row_number() OVER (PARTITION BY svc, event_type ORDER BY d) AS r FROM hist
        )
        SELECT svc AS ServiceName, event_type, midnight + {_DAY_NS} - 1 AS TimeUnixNanos,
               CASE WHEN r = 1 THEN 0 ELSE n END AS Count,
               CASE WHEN r = 1 THEN 0 ELSE total END AS total,
               CASE WHEN r = 1 THEN '{",".join(["0"] * (len(BOUNDS) + 1))}'
                    ELSE {" || ',' || ".join(f"CAST(b{i} AS VARCHAR)" for i in range(len(BOUNDS) + 1))}
               END AS buckets
        FROM numbered
        """,
    ),
    "exp_histogram_delta": _with(
        ["expo"],
        f"""
        , signed AS (
            SELECT svc, d, midnight, cents, CASE WHEN cents <= 1 THEN -1 ELSE length(bin(cents - 1)) - 1 END AS idx,
                   CASE WHEN cents % 10 = 0 THEN 0 WHEN event_id % 3 = 0 THEN -1 ELSE 1 END AS side
            FROM ev
        ), per_day AS (
            SELECT svc, d, midnight, count(*) AS events, CAST(sum(side * cents) AS BIGINT) AS total,
                   row_number() OVER (PARTITION BY svc ORDER BY d) AS r
            FROM signed GROUP BY svc, d, midnight
        ), coarse AS (
            SELECT *, CASE WHEN day(d) >= 15 THEN 2.0 ELSE 1.0 END AS step,
                   CASE WHEN day(d) >= 15 THEN floor(idx / 2.0) ELSE idx END AS i
            FROM signed
        ), buckets AS (
            SELECT svc, d, CASE side WHEN 0 THEN 0.0 WHEN 1 THEN pow(2.0, i * step) ELSE -pow(2.0, (i + 1) * step) END AS lower,
                   CASE side WHEN 0 THEN 0.0 WHEN 1 THEN pow(2.0, (i + 1) * step) ELSE -pow(2.0, i * step) END AS upper
            FROM coarse
        )
        SELECT svc AS ServiceName, midnight + {_DAY_NS} - 1 AS TimeUnixNanos, events, total,
               CAST(lower AS DOUBLE) AS lower, CAST(upper AS DOUBLE) AS upper, count(*) AS count
        FROM buckets JOIN per_day USING (svc, d) WHERE r > 1
        GROUP BY svc, midnight, events, total, lower, upper
        """,
    ),
    "trace_timeline": _with(
        ["spans"],
        f"""
        SELECT TraceId, SpanId, SpanName, TimestampNanos,
               TimestampNanos - min(TimestampNanos) OVER () AS OffsetNanos, Duration
        FROM spans WHERE TraceId = '{TRACE_ID}' ORDER BY TimestampNanos, SpanId
        """,
    ),
    "slowest_spans": _with(
        ["spans"],
        """
        , ranked AS (
            SELECT *, row_number() OVER (PARTITION BY ServiceName
                   ORDER BY Duration DESC, SpanId, TraceId) AS per_service,
                   row_number() OVER (ORDER BY Duration DESC, SpanId, TraceId) AS overall
            FROM spans
        )
        SELECT 'service' AS scope, ServiceName, SpanId, Duration FROM ranked WHERE per_service <= 5
        UNION ALL
        SELECT 'all', ServiceName, SpanId, Duration FROM ranked WHERE overall <= 20
        """,
    ),
    "stream_logs": _LOGS,
    "stream_traces": _SPANS,
    "stream_metrics": _METRICS,
    "stream_trace_lookup": _with(
        ["spans"],
        """
        SELECT substr(TraceId, 1, 1) AS digit, count(DISTINCT TraceId) AS traces,
               min(TimestampNanos) // 1000000000 AS first_s,
               max(TimestampNanos) // 1000000000 AS last_s
        FROM spans WHERE TraceId <> '' GROUP BY digit
        """,
    ),
    "collapse_lookup": _LOOKUP,
    "expire_rows": _with(
        ["logs"],
        """
        SELECT TimestampNanos, ServiceName FROM logs
        WHERE (TimestampNanos // 1000000000 + 20 * 86400) * 1000000
              > epoch_us(TIMESTAMP '2024-01-28 12:00:00')
        """,
    ),
    "expired_partitions": _with(
        ["spans"],
        """
        SELECT CAST(d AS VARCHAR) AS EventDate, max(TimestampNanos // 1000) AS last_us
        FROM spans GROUP BY d
        HAVING (max(TimestampNanos) // 1000000000 + 20 * 86400) * 1000000
               <= epoch_us(TIMESTAMP '2024-01-28 12:00:00')
        """,
    ),
}

ORACLE_SQL["merge_days"] = _with(
    ["spans"],
    """
    SELECT CAST(d AS VARCHAR) AS EventDate, count(*) AS spans, CAST(sum(Duration) AS BIGINT) AS duration,
           count(DISTINCT SpanId) AS ids,
           CASE WHEN d < DATE '2024-01-20' THEN 1 END AS files
    FROM spans GROUP BY d
    """,
)
# A day is dropped when its last row has expired.
ORACLE_SQL["drop_expired"] = _with(
    ["spans"],
    """
    SELECT CAST(d AS VARCHAR) AS EventDate, count(*) AS spans FROM spans GROUP BY d
    HAVING (max(TimestampNanos) // 1000000000 + 20 * 86400) * 1000000
           > epoch_us(TIMESTAMP '2024-01-28 12:00:00')
    """,
)

# The same events told twice as cumulative runs; runs have no extremes of their own.
ORACLE_SQL["merge_exp_cumulative"] = ORACLE_SQL["merge_exp_histograms"].replace(
    "s.n AS Count, s.total, s.low,\n               s.high,", "s.n AS Count, s.total,"
)
