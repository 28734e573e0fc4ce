"""Batch ingest that stores good rows, bad rows and bad lines from one read."""

from __future__ import annotations

from functools import partial

from pyspark.sql import SparkSession

from signalbarn.functions.jobs import run_together
from signalbarn.operators.rows import ROW
from signalbarn.session import scratch_dir
from signalbarn.sources.batches import read_batches
from signalbarn.sources.staging import stage, tables_of
from signalbarn.sources.tables import metric_path, write_rejects, write_table


def ingest(
    spark: SparkSession, signal: str, path: str, target: str, mode: str = "append"
) -> dict[tuple[str, str], int]:
    """Read nested batches once; rows go to `target/<table name>`, rejects to `target/rejects`.

    Returns how many records became what, by (outcome, table): every record and
    every malformed line of the input is in exactly one of the counts, or
    nothing is written and the ingest fails.
    """
    staged = stage(read_batches(spark, signal, path), signal, scratch_dir(spark, f"ingest-{signal}"))
    jobs = [
        partial(write_table, staged.rows(table), table, metric_path(target, table), mode)
        for table in tables_of(signal)
        if (ROW, table) in staged.counts
    ]
    if staged.rejected:
        jobs.append(partial(write_rejects, staged.rejects(), f"{target}/rejects", mode))
    run_together(spark, jobs)
    staged.drop()
    return staged.counts
