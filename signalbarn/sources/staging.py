"""One read of nested batches: every record becomes a row or a reject, and the counts must balance.

JSON is parsed once. What comes out is written once, unsorted, as Parquet in the
shared folder, divided by outcome and table; the sorted writes of the tables read
only their part of it, and only its columns. Beside it the batches themselves
count what they hold, line by line and without exploding, in the same pass.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from signalbarn.functions.files import Store
from signalbarn.operators.rows import BAD_LINE, ROW, tagged_rows
from signalbarn.schemas import CORRUPT, METRIC_TABLES, TABLES
from signalbarn.sources.batches import flatten_all, point_count, record_count


def tables_of(signal: str) -> tuple[str, ...]:
    return METRIC_TABLES if signal == "metrics" else (signal,)


class UnbalancedIngest(RuntimeError):
    """Records that were read and are neither rows nor rejects, or the other way round."""


@dataclass(frozen=True)
class Staged:
    """What one read gave: its files, and the number of records by (outcome, table)."""

    spark: SparkSession
    path: str
    schema: StructType
    counts: dict[tuple[str, str], int]

    def _read(self) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(self.path)

    def rows(self, table: str) -> DataFrame:
        """The rows of one table, unsorted."""
        own = self._read().filter((F.col("Outcome") == ROW) & (F.col("Kind") == table))
        return own.select(*[f.name for f in StructType.fromDDL(TABLES[table].ddl).fields])

    def rejects(self) -> DataFrame:
        """Malformed lines, and records or points no table can hold, whole."""
        bad = self._read().filter(F.col("Outcome") != ROW)
        return bad.select(F.col("Outcome").alias("Level"), "Reason", "Raw")

    @property
    def rejected(self) -> int:
        return sum(n for (outcome, _), n in self.counts.items() if outcome != ROW)

    def drop(self) -> None:
        Store(self.spark, self.path).delete(self.path)


def stage_records(records: DataFrame, signal: str, folder: str) -> Staged:
    """Parse flattened records once and write the outcome below `folder`, replacing what is there."""
    spark = records.sparkSession
    tagged = tagged_rows(records, signal)
    tagged.write.mode("overwrite").partitionBy("Outcome", "Kind").option("compression", "zstd").parquet(folder)
    # the folder of a part is its outcome and table; with none there is nothing to read
    stored = spark.read.schema(tagged.schema).parquet(folder)
    counts = stored.groupBy("Outcome", "Kind").count().collect()  # one row per outcome and table
    return Staged(spark, folder, tagged.schema, {(r["Outcome"], r["Kind"]): r["count"] for r in counts})


def stage(batches: DataFrame, signal: str, folder: str) -> Staged:
    """The same from batches, with an account: raises `UnbalancedIngest` where the counts differ."""
    seen = Observation()
    entries = point_count() if signal == "metrics" else record_count(signal)
    good = F.col(CORRUPT).isNull()
    watched = batches.observe(
        seen,
        F.count(F.when(~good, 1)).alias("lines"),
        F.coalesce(F.sum(F.when(good, entries)), F.lit(0).cast("bigint")).alias("entries"),
    )
    staged = stage_records(flatten_all(watched, signal), signal, folder)
    expected, lines = seen.get["entries"], staged.counts.get((BAD_LINE, "none"), 0)
    entries_out = sum(n for (outcome, _), n in staged.counts.items() if outcome != BAD_LINE)
    if (expected, seen.get["lines"]) != (entries_out, lines):
        raise UnbalancedIngest(
            f"{signal}: {expected} records and {seen.get['lines']} malformed lines were read, "
            f"{entries_out} and {lines} accounted for"
        )
    return staged
