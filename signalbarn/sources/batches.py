"""Reading nested telemetry batches (one JSON object per line) and flattening them.

Flattening is three `explode`s: resource, scope, record. `flatten` gives the
records of good lines, `flatten_all` also the malformed lines; storing both, with
counts that must balance, is what `staging.ingest` does.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from signalbarn.operators.rows import METRIC_KINDS
from signalbarn.schemas import BATCHES, CORRUPT


def read_batches(spark: SparkSession, signal: str, path: str) -> DataFrame:
    return spark.read.schema(BATCHES[signal].ddl).option(
        "columnNameOfCorruptRecord", CORRUPT
    ).json(path)


def read_batch_stream(
    spark: SparkSession, signal: str, path: str, max_files: int | None = None
) -> DataFrame:
    reader = (
        spark.readStream.schema(BATCHES[signal].ddl)
        .option("columnNameOfCorruptRecord", CORRUPT)
    )
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.json(path)


def _as_rejects(lines: DataFrame, raw: str) -> DataFrame:
    return lines.select(
        F.lit("line").alias("Level"),
        F.lit("malformed batch line").alias("Reason"),
        F.col(raw).alias("Raw"),
    )


def rejected_lines(spark: SparkSession, signal: str, path: str) -> DataFrame:
    """Lines that could not be read as a batch, whole, for repair and replay.

    Spark does not answer queries on the corrupt column of a JSON file alone,
    so the lines are read as text and parsed by the same schema.
    """
    parsed = F.from_json("value", BATCHES[signal].ddl, {"mode": "PERMISSIVE"})
    lines = spark.read.text(path).filter(F.trim("value") != "").withColumn("_batch", parsed)
    return _as_rejects(lines.filter(F.col(f"_batch.{CORRUPT}").isNotNull()), "value")


def malformed(batches: DataFrame) -> DataFrame:
    """The same lines from batches that are persisted or stored."""
    return _as_rejects(batches.filter(F.col(CORRUPT).isNotNull()), CORRUPT)


def flatten(batches: DataFrame, signal: str) -> DataFrame:
    """One row per record: `resource`, `resourceSchemaUrl`, `scope`, `scopeSchemaUrl`, `record`."""
    shape = BATCHES[signal]
    good = batches.filter(F.col(CORRUPT).isNull())
    resources = good.select(F.explode(shape.resources).alias("r"))
    scopes = resources.select(
        F.col("r.resource").alias("resource"),
        F.col("r.schemaUrl").alias("resourceSchemaUrl"),
        F.explode(f"r.{shape.scopes}").alias("s"),
    )
    return scopes.select(
        "resource",
        "resourceSchemaUrl",
        F.col("s.scope").alias("scope"),
        F.col("s.schemaUrl").alias("scopeSchemaUrl"),
        F.explode(f"s.{shape.records}").alias("record"),
    )


def flatten_all(batches: DataFrame, signal: str) -> DataFrame:
    """The records of `flatten`, and one row without a record for each malformed line, which it keeps whole."""
    shape = BATCHES[signal]
    resources = batches.select(CORRUPT, F.explode_outer(shape.resources).alias("r"))
    scopes = resources.select(
        CORRUPT,
        F.col("r.resource").alias("resource"),
        F.col("r.schemaUrl").alias("resourceSchemaUrl"),
        F.explode_outer(f"r.{shape.scopes}").alias("s"),
    )
    # the position tells an empty list from a list with an empty entry
    records = scopes.select(
        CORRUPT,
        "resource",
        "resourceSchemaUrl",
        F.col("s.scope").alias("scope"),
        F.col("s.schemaUrl").alias("scopeSchemaUrl"),
        F.posexplode_outer(f"s.{shape.records}").alias("_at", "record"),
    )
    return records.filter(F.col("_at").isNotNull() | F.col(CORRUPT).isNotNull()).drop("_at")


def read_otlp_logs(spark: SparkSession, path: str) -> DataFrame:
    """One row per log record with its resource and scope."""
    return flatten(read_batches(spark, "logs", path), "logs")


def read_otlp_traces(spark: SparkSession, path: str) -> DataFrame:
    """One row per span with its resource and scope."""
    return flatten(read_batches(spark, "traces", path), "traces")


def read_otlp_metrics(spark: SparkSession, path: str) -> DataFrame:
    """One row per metric with its resource and scope; see `data_points` for points."""
    return flatten(read_batches(spark, "metrics", path), "metrics")


def _length(a: Column) -> Column:
    return F.when(a.isNull(), F.lit(0)).otherwise(F.coalesce(F.size(a), F.lit(0))).cast("bigint")


def _count_inside(items: Column, count: Callable[[Column], Column]) -> Column:
    """The sum of `count` over the entries of a list that may be absent."""
    zero = F.lit(0).cast("bigint")
    return F.coalesce(F.aggregate(items, zero, lambda n, x: n + F.coalesce(count(x), zero)), zero)


def record_count(signal: str) -> Column:
    """Records of a batch, without exploding it."""
    shape = BATCHES[signal]
    return _count_inside(
        F.col(shape.resources),
        lambda r: _count_inside(r[shape.scopes], lambda s: _length(s[shape.records])),
    )


def point_count() -> Column:
    """Data points of a metric batch, without exploding it."""
    shape = BATCHES["metrics"]

    def points(metric: Column) -> Column:
        return sum((_length(metric[wire]["dataPoints"]) for wire in METRIC_KINDS), F.lit(0).cast("bigint"))

    return _count_inside(
        F.col(shape.resources),
        lambda r: _count_inside(r[shape.scopes], lambda s: _count_inside(s[shape.records], points)),
    )


def batch_summary(batches: DataFrame, signal: str) -> DataFrame:
    """Resource and record counts of each batch, without exploding it.

    Every resource entry counts, even an empty one. For metrics the record
    count is the number of metrics, not of data points.
    """
    return batches.filter(F.col(CORRUPT).isNull()).select(
        _length(F.col(BATCHES[signal].resources)).alias("resource_count"),
        record_count(signal).alias("record_count"),
    )


def batch_summary_logs(batches: DataFrame) -> DataFrame:
    return batch_summary(batches, "logs")


def batch_summary_traces(batches: DataFrame) -> DataFrame:
    return batch_summary(batches, "traces")


def batch_summary_metrics(batches: DataFrame) -> DataFrame:
    return batch_summary(batches, "metrics")
