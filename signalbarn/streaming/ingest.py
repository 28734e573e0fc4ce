"""Streams of nested batches into the tables, and spans into the trace lookup.

Each micro-batch is parsed once, staged, and published into the day folders by
`commit_batch`: a batch replayed after a failure neither doubles nor loses rows.
Targets are folders or the catalog tables of `ensure_tables`. There is no state
and no watermark: late rows land in the folder of their own day.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from signalbarn.functions.jobs import run_together
from signalbarn.operators.rows import ROW
from signalbarn.operators.traces import trace_id_ts
from signalbarn.sources.batches import read_batch_stream
from signalbarn.sources.staging import stage, tables_of
from signalbarn.sources.tables import (
    Promoted,
    metric_path,
    table_location,
    table_schema,
    with_promoted,
    write_rejects,
    write_table,
)
from signalbarn.streaming.commit import Part, commit_batch

Trigger = dict


def stream_name(df: DataFrame) -> str:
    """The query's id, which its checkpoint keeps: the same on replay and another one for each stream."""
    return df.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or "stream"


def _run(
    source: DataFrame,
    sink: Callable[[DataFrame, int], None],
    checkpoint: str,
    trigger: Trigger | None,
) -> StreamingQuery:
    return (
        source.writeStream.foreachBatch(sink)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def stream_ingest(
    spark: SparkSession,
    signal: str,
    source: str,
    target: str,
    checkpoint: str,
    trigger: Trigger | None = None,
    max_files: int | None = None,
    tables: dict[str, str] | None = None,
    promoted: Promoted | None = None,
) -> StreamingQuery:
    """Continuous batches of one signal into its table (five tables for metrics).

    `tables` maps a table to its catalog name. Without it logs and spans go to
    `target/rows` and metrics to `target/<table name>`. What cannot be stored
    goes whole to `target/rejects`. `promoted` names the attributes of logs or
    spans that get columns of their own.
    """
    names = tables or {}
    paths = {
        t: table_location(spark, names[t])
        if t in names
        else (metric_path(target, t) if signal == "metrics" else f"{target}/rows")
        for t in tables_of(signal)
    }

    def sink(batches: DataFrame, batch_id: int) -> None:
        session = batches.sparkSession

        def prepare(folder: str) -> list[Part]:
            staged = stage(batches, signal, f"{folder}/parsed")
            found = [t for t in paths if (ROW, t) in staged.counts]
            jobs = [
                partial(write_table, with_promoted(staged.rows(t), promoted), t, f"{folder}/{t}", "overwrite")
                for t in found
            ]
            parts = [Part(f"{folder}/{t}", paths[t], t, names.get(t)) for t in found]
            if staged.rejected:
                jobs.append(partial(write_rejects, staged.rejects(), f"{folder}/rejects", "overwrite"))
                parts.append(Part(f"{folder}/rejects", f"{target}/rejects"))
            run_together(session, jobs)
            return parts

        commit_batch(session, f"{target}/_ledger", stream_name(batches), batch_id, prepare)

    return _run(read_batch_stream(spark, signal, source, max_files), sink, checkpoint, trigger)


def stream_route_metrics(
    spark: SparkSession,
    source: str,
    target: str,
    checkpoint: str,
    trigger: Trigger | None = None,
    max_files: int | None = None,
    tables: dict[str, str] | None = None,
) -> StreamingQuery:
    """One stream of metric batches into the five metrics tables."""
    return stream_ingest(spark, "metrics", source, target, checkpoint, trigger, max_files, tables)


def stream_trace_lookup(
    spark: SparkSession,
    spans_path: str,
    lookup_path: str,
    checkpoint: str,
    trigger: Trigger | None = None,
    max_files: int | None = None,
    full_name: str | None = None,
) -> StreamingQuery:
    """Time ranges of the traces of each newly written batch of spans.

    Every batch adds its own partial rows and never changes earlier ones;
    readers merge them with `collapse_lookup`. With `full_name`, a catalog table
    whose folder is `lookup_path`, the rows become its partitions.
    """
    reader = spark.readStream.schema(table_schema("traces"))
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    spans = reader.parquet(spans_path)

    def sink(batch_spans: DataFrame, batch_id: int) -> None:
        def prepare(folder: str) -> list[Part]:
            write_table(trace_id_ts(batch_spans), "lookup", f"{folder}/lookup", "overwrite")
            return [Part(f"{folder}/lookup", lookup_path, "lookup", full_name)]

        commit_batch(batch_spans.sparkSession, f"{lookup_path}/_ledger", stream_name(batch_spans), batch_id, prepare)

    return _run(spans.select("TraceId", "TimestampNanos"), sink, checkpoint, trigger)
