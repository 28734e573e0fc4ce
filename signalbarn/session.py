"""Session settings the operators rely on."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

from signalbarn.functions.files import Store

# Settings that change results, so every entry point applies them.
RESULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    # Telemetry maps may repeat a key; the last value wins instead of an error.
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
}

# Settings that only change speed. AQE coalesces small shuffle partitions and
# splits skewed join sides and rebalanced writes at run time.
SPEED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the result-affecting settings to an existing session."""
    for key, value in RESULT_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = 8, app: str = "signalbarn", **extra: str) -> SparkSession:
    """A single-JVM session for tests and local benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.driver.memory", "12g")
    )
    for key, value in {**RESULT_CONF, **SPEED_CONF, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_local_folder: str | None = None


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder for written intermediate tables.

    Read from the session (`spark.checkpoint.dir`). Only where the session has
    none, as in tests on one machine, a fresh local folder is used.
    """
    global _local_folder
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        _local_folder = _local_folder or tempfile.mkdtemp(prefix="signalbarn-")
        folder = _local_folder
    return folder.rstrip("/")


def _own_scratch(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/signalbarn/{spark.sparkContext.applicationId}"


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder, in the part of this application."""
    return f"{_own_scratch(spark)}/{label}-{uuid.uuid4().hex}"


def drop_scratch(spark: SparkSession) -> None:
    """Delete what this application has written with `scratch_dir`, once nothing reads it any more.

    Results are computed late and read such tables, so nothing is deleted by itself.
    """
    folder = _own_scratch(spark)
    Store(spark, folder).delete(folder)
