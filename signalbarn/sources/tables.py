"""Day-partitioned Parquet tables: create, write, scan, expire."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable
from dataclasses import dataclass
from datetime import date, datetime, timedelta
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from signalbarn.functions.columns import (
    in_day_range,
    in_time_range,
    promoted_name,
    ttl_interval,
    ttl_seconds,
)
from signalbarn.functions.files import Store
from signalbarn.functions.jobs import run_together
from signalbarn.operators.rows import REJECT, ROW
from signalbarn.schemas import LOOKUPS, METRIC_TABLES, TABLES, TableSpec
from signalbarn.session import scratch_dir
from signalbarn.sources.staging import stage_records

def spec_of(table: str) -> TableSpec:
    """Schema and layout of a table or lookup."""
    return TABLES.get(table) or LOOKUPS[table]


#: Attribute maps and the keys of them that are columns of their own.
Promoted = dict[str, list[str]]


def table_schema(table: str, promoted: Promoted | None = None) -> StructType:
    """Stored schema including promoted attributes and the partition day."""
    spec = spec_of(table)
    names = [promoted_name(m, k) for m, keys in (promoted or {}).items() for k in keys]
    extra = "".join(f", {n} STRING" for n in names)
    return StructType.fromDDL(f"{spec.ddl}{extra}, {spec.day} DATE")


#: The largest Bloom filter of a row group, unless another is asked for: room for some 2 million ids.
BLOOM_BYTES = 4 * 1024 * 1024


def layout_options(
    table: str, distinct_ids: int | None = None, bloom_bytes: int = BLOOM_BYTES
) -> dict[str, str]:
    """Parquet writer options: compression and Bloom filters on the id columns.

    The filters size themselves to the ids a row group really holds, up to
    `bloom_bytes`; files with larger row groups ask for more. With `distinct_ids` they have the fixed size for that many ids instead, which
    is cheaper to write but wasteful in small files.
    """
    options = {"compression": "zstd"}
    bloom = spec_of(table).bloom
    for column, rate in bloom.items():
        options[f"parquet.bloom.filter.enabled#{column}"] = "true"
        options[f"parquet.bloom.filter.fpp#{column}"] = str(rate)
        if distinct_ids is not None:
            options[f"parquet.bloom.filter.expected.ndv#{column}"] = str(distinct_ids)
    if bloom:
        options["parquet.bloom.filter.max.bytes"] = str(bloom_bytes)
        if distinct_ids is None:
            options["parquet.bloom.filter.adaptive.enabled"] = "true"
    return options


def with_day(df: DataFrame, table: str) -> DataFrame:
    """The table's columns plus its partition day."""
    spec = spec_of(table)
    names = [f.name for f in StructType.fromDDL(spec.ddl).fields]
    extra = [c for c in df.columns if c.startswith("attr_")]
    return df.select(*names, *extra, F.to_date(spec.time).alias(spec.day))


def cluster_sort(df: DataFrame, table: str) -> DataFrame:
    """Rows grouped by day and sorted by the table's key inside each task.

    The rebalance is one shuffle by day. At run time AQE splits a large day
    over many tasks and packs small days together, so neither a busy day nor
    many small files need a hand-set number.
    """
    spec = spec_of(table)
    return df.hint("rebalance", spec.day).sortWithinPartitions(spec.day, *spec.sort)


def promote_attrs(df: DataFrame, column: str, keys: list[str]) -> DataFrame:
    """Copy hot attributes of one map to top-level columns, see `promoted_name`.

    Parquet statistics and pushdown work on these; on map entries they do not.
    Read them back with the same maps and keys as `promoted`.
    """
    return df.withColumns(
        {
            promoted_name(column, k): F.coalesce(F.try_element_at(column, F.lit(k)), F.lit(""))
            for k in keys
        }
    )


def write_table(
    df: DataFrame, table: str, path: str, mode: str = "append", options: dict[str, str] | None = None
) -> None:
    """Sorted, day-partitioned, compressed write; `options` are `layout_options` other than the usual ones."""
    day = spec_of(table).day
    (
        cluster_sort(with_day(df, table), table)
        .write.mode(mode)
        .options(**(options or layout_options(table)))
        .partitionBy(day)
        .parquet(path)
    )


def write_rejects(rejects: DataFrame, path: str, mode: str = "append") -> None:
    """Rejects as (Level, Reason, Raw), for repair and replay."""
    rejects.write.mode(mode).option("compression", "zstd").parquet(path)


def read_rejects(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(REJECT).parquet(path)


def write_logs(df: DataFrame, path: str, mode: str = "append") -> None:
    write_table(df, "logs", path, mode)


def write_traces(df: DataFrame, path: str, mode: str = "append") -> None:
    write_table(df, "traces", path, mode)


def write_trace_lookup(df: DataFrame, path: str, mode: str = "append") -> None:
    write_table(df, "lookup", path, mode)


def write_lookup(df: DataFrame, table: str, path: str, mode: str = "append") -> None:
    """Append the rows of a lookup of our own, which carry their day."""
    spec = spec_of(table)
    rows = df.hint("rebalance", spec.day).sortWithinPartitions(spec.day, *spec.sort)
    rows.write.mode(mode).options(**layout_options(table)).partitionBy(spec.day).parquet(path)


def metric_path(root: str, table: str) -> str:
    return f"{root}/{spec_of(table).name}"


def write_metrics(records: DataFrame, root: str, mode: str = "append") -> None:
    """Route metric records by type into five tables; unfit points go to `rejects`.

    The records are parsed once, into Parquet in the shared folder that is
    divided by type; each of the writes reads its own part.
    """
    staged = stage_records(records, "metrics", scratch_dir(records.sparkSession, "route"))
    jobs = [
        partial(write_table, staged.rows(table), table, metric_path(root, table), mode)
        for table in METRIC_TABLES
        if (ROW, table) in staged.counts or mode == "overwrite"
    ]
    if staged.rejected or mode == "overwrite":
        jobs.append(partial(write_rejects, staged.rejects(), f"{root}/rejects", mode))
    run_together(records.sparkSession, jobs)
    staged.drop()


# ---------------------------------------------------------------- reading


def read_table(
    spark: SparkSession, table: str, path: str, promoted: Promoted | None = None
) -> DataFrame:
    """The whole stored table, without schema inference.

    Promoted attributes of files that were written without them are NULL.
    """
    return spark.read.schema(table_schema(table, promoted)).parquet(path)


def scan(
    spark: SparkSession,
    table: str,
    path: str,
    start: int | datetime | None = None,
    end: int | datetime | None = None,
    promoted: Promoted | None = None,
) -> DataFrame:
    """Rows with time in `[start, end)`, reading only the days that can hold them."""
    return time_filter(read_table(spark, table, path, promoted), table, start, end)


def time_filter(
    df: DataFrame, table: str, start: int | datetime | None, end: int | datetime | None
) -> DataFrame:
    """A time filter alone does not prune partitions; the day filter does."""
    spec = spec_of(table)
    if table == "lookup":
        nanos = F.unix_micros(spec.time) * 1000
    else:
        nanos = F.col(f"{spec.time}Nanos")
    return df.filter(in_day_range(spec.day, start, end) & in_time_range(nanos, start, end))


# ---------------------------------------------------------------- catalog


def ensure_tables(
    spark: SparkSession,
    database: str = "otel",
    location: str | None = None,
    promoted: dict[str, Promoted] | None = None,
) -> list[str]:
    """Create the database and its eight tables where absent; return their names.

    The database is not created for the empty name or `default`. `promoted`
    names, by table, the attributes that get columns of their own.
    """
    use_default = database in ("", "default")
    if not use_default:
        where = f" LOCATION '{location}'" if location else ""
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`{where}")
    names = []
    for table, spec in TABLES.items():
        full = f"`{spec.name}`" if use_default else f"`{database}`.`{spec.name}`"
        options = ", ".join(f"'{k}'='{v}'" for k, v in layout_options(table).items())
        at = f" LOCATION '{location}/{spec.name}'" if use_default and location else ""
        columns = ", ".join(
            f"`{f.name}` {f.dataType.simpleString()}"
            for f in table_schema(table, (promoted or {}).get(table)).fields
        )
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {full} ({columns}) "
            f"USING parquet OPTIONS ({options}) PARTITIONED BY ({spec.day}){at}"
        )
        names.append(full.replace("`", ""))
    return names


def with_promoted(df: DataFrame, promoted: Promoted | None) -> DataFrame:
    """The attributes of several maps as columns, see `promote_attrs`."""
    for column, keys in (promoted or {}).items():
        df = promote_attrs(df, column, keys)
    return df


def insert_rows(df: DataFrame, table: str, full_name: str, promoted: Promoted | None = None) -> None:
    """Append rows to a catalog table made by `ensure_tables`, column by column name.

    Promoted columns of the table that are not asked for stay NULL, like in files
    written before the promotion.
    """
    rows = cluster_sort(with_day(with_promoted(df, promoted), table), table)
    wanted = df.sparkSession.table(full_name).schema.fields
    own = {c.lower() for c in rows.columns}
    rows.select(
        *[
            F.col(f.name) if f.name.lower() in own else F.lit(None).cast(f.dataType).alias(f.name)
            for f in wanted
        ]
    ).write.insertInto(full_name)


# ---------------------------------------------------------------- days of a table


def day_of_folder(path: str, table: str) -> str:
    """The day, as text, that a file's folder stands for."""
    return re.search(rf"/{spec_of(table).day}=(\d{{4}}-\d{{2}}-\d{{2}})/", path)[1]


def table_location(spark: SparkSession, full_name: str) -> str:
    """The folder of a catalog table."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {full_name}").filter("col_name = 'Location'")
    return rows.first()["data_type"].rstrip("/")


def catalog_days(spark: SparkSession, table: str, full_name: str) -> list[str]:
    """Days of a catalog table, from its partition list alone."""
    rows = spark.sql(f"SHOW PARTITIONS {full_name}").collect()  # one row per calendar day
    return sorted(r[0].split("=", 1)[1] for r in rows)


def _partition(table: str, day: str) -> str:
    return f"PARTITION ({spec_of(table).day} = DATE'{day}')"


def day_folder(spark: SparkSession, table: str, full_name: str, day: str) -> str:
    """Where a day of a catalog table lies; merged days lie outside the table's folder."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {full_name} {_partition(table, day)}")
    return rows.filter("col_name = 'Location'").first()["data_type"].rstrip("/")


def day_folders(
    spark: SparkSession, table: str, path: str, full_name: str | None, days: list[str]
) -> dict[str, str]:
    """The folder of each day, for days the table does not have yet the usual one."""
    known = set(catalog_days(spark, table, full_name)) if full_name else set()
    return {
        d: day_folder(spark, table, full_name, d) if d in known else f"{path}/{spec_of(table).day}={d}"
        for d in days
    }


def add_days(spark: SparkSession, table: str, full_name: str, folders: dict[str, str]) -> None:
    """Make the catalog know days whose files were put into their folders."""
    new = " ".join(f"{_partition(table, d)} LOCATION '{f}'" for d, f in sorted(folders.items()))
    spark.sql(f"ALTER TABLE {full_name} ADD IF NOT EXISTS {new}")
    spark.catalog.refreshTable(full_name)


@dataclass(frozen=True)
class MergedDay:
    """A day whose files were rewritten: its new folder, and the files no reader needs any more."""

    day: str
    folder: str
    files: int
    replaced: tuple[str, ...]


def merge_day(
    spark: SparkSession, table: str, full_name: str, day: str, file_bytes: int, before_swap: Callable[[], None] | None = None
) -> MergedDay | None:
    """Rewrite one day as few sorted files and swap it in one step; None if that would not help.

    The new files lie in a folder of their own. The catalog then points the day
    to it, which is the swap: queries planned before go on reading the old files,
    which stay until `drop_replaced`. A rewrite that stops halfway leaves the
    table as it was. Files that arrived in the old folder meanwhile are moved
    along; a note in the new folder lets the next call do so if this one ends
    right after the swap. `before_swap` runs last before the swap.
    """
    store = Store(spark, table_location(spark, full_name))
    old = day_folder(spark, table, full_name, day)
    files = store.files(old)
    wanted = max(1, -(-sum(size for _, size in files) // file_bytes))
    if len(files) <= wanted:
        return None
    spec = spec_of(table)
    stored = spark.table(full_name).schema
    schema = StructType([f for f in stored.fields if f.name != spec.day])
    rows = spark.read.schema(schema).parquet(*[f for f, _ in files])
    folder = f"{table_location(spark, full_name)}-merged/{day}-{uuid.uuid4().hex}"
    merged = rows.repartitionByRange(wanted, *spec.sort) if wanted > 1 else rows.coalesce(1)
    merged.sortWithinPartitions(*spec.sort).write.options(**layout_options(table)).parquet(folder)
    if rows.count() != spark.read.schema(schema).parquet(folder).count():
        store.delete(folder)
        raise RuntimeError(f"{full_name}, {day}: the rewritten day has another number of rows")
    replaced = tuple(f for f, _ in files)
    store.write_note(f"{folder}/{_SWAPPED}", {"old": old, "replaced": replaced})
    if before_swap:
        before_swap()
    spark.sql(f"ALTER TABLE {full_name} {_partition(table, day)} SET LOCATION '{folder}'")
    _bring_late_files(store, folder)
    spark.catalog.refreshTable(full_name)
    return MergedDay(day, folder, len(store.files(folder)), replaced)


#: Beside the files of a merged day: where they came from, until late files of that folder have been moved along.
_SWAPPED = "_swapped.json"


def _bring_late_files(store: Store, folder: str) -> None:
    note = store.note(f"{folder}/{_SWAPPED}")
    if note:
        for file, _ in store.files(note["old"]):
            if file not in note["replaced"]:
                store.move(file, f"{folder}/{file.rsplit('/', 1)[1]}")
        store.delete(f"{folder}/{_SWAPPED}")


def merge_days(
    spark: SparkSession, table: str, full_name: str, closed_before: date, file_bytes: int = 256 * 1024 * 1024
) -> list[MergedDay]:
    """Rewrite the days before `closed_before` that have more files than their size asks for.

    Late rows that streams publish to a merged day go to its new folder and are
    merged by the next call.
    """
    days = [d for d in catalog_days(spark, table, full_name) if d < closed_before.isoformat()]
    store = Store(spark, table_location(spark, full_name))
    for day in days:  # swaps whose call did not end
        _bring_late_files(store, day_folder(spark, table, full_name, day))
    spark.catalog.refreshTable(full_name)
    done = (merge_day(spark, table, full_name, d, file_bytes) for d in days)
    return [m for m in done if m]


def drop_replaced(spark: SparkSession, merged: list[MergedDay]) -> int:
    """Delete the files that merged days replaced, once no query reads them; returns how many."""
    files = [f for m in merged for f in m.replaced]
    for file in files:
        Store(spark, file).delete(file)
    return len(files)


# ---------------------------------------------------------------- retention


def _expired(time: Column, ttl: timedelta, now: datetime) -> Column:
    return F.date_trunc("second", time) + ttl_interval(ttl) <= F.lit(now).cast("timestamp")


def expire_rows(df: DataFrame, time: str, ttl: timedelta, now: datetime) -> DataFrame:
    """Rows still inside their retention time at `now`; no retention keeps all."""
    if ttl <= timedelta(0):
        return df
    return df.filter(~_expired(F.col(time), ttl, now))


def expired_partitions(df: DataFrame, table: str, ttl: timedelta, now: datetime) -> DataFrame:
    """Days whose last row has expired, with that row's time.

    A day cannot be fully expired before its first second is, so later days are
    pruned without being read.
    """
    spec = spec_of(table)
    if ttl <= timedelta(0):
        return df.select(spec.day, F.col(spec.time).alias("LastTime")).filter(F.lit(False))
    latest = (now - timedelta(seconds=ttl_seconds(ttl))).date()
    return (
        df.filter(F.col(spec.day) <= F.lit(latest))
        .groupBy(spec.day)
        .agg(F.max(spec.time).alias("LastTime"))
        .filter(_expired(F.col("LastTime"), ttl, now))
    )


def _border(ttl: timedelta, now: datetime) -> tuple[date, date]:
    """Days before the first date are expired whatever their rows; from the second date on none can be."""
    latest = now - timedelta(seconds=ttl_seconds(ttl))  # a row of this second or before has expired
    ended = (latest + timedelta(seconds=1)).date()  # the first day whose last second is later
    return ended, latest.date() + timedelta(days=1)


def _days_to_drop(
    rows: Callable[[], DataFrame], days: list[str], table: str, ttl: timedelta, now: datetime
) -> list[date]:
    """Of the days a table has: those that ended in time, and of the border days those whose rows have expired.

    Only border days, at most one, are read.
    """
    if ttl <= timedelta(0):
        return []
    spec, known = spec_of(table), [date.fromisoformat(d) for d in days]
    ended, none = _border(ttl, now)
    border = [d for d in known if ended <= d < none]
    found = [d for d in known if d < ended]
    if border:
        own = rows().filter(F.col(spec.day).isin(border))
        found += [r[0] for r in expired_partitions(own, table, ttl, now).select(spec.day).collect()]
    return sorted(found)


def expired_days(
    spark: SparkSession, table: str, full_name: str, ttl: timedelta, now: datetime
) -> list[date]:
    """The days of a catalog table whose last row has expired, from the partition list."""
    days = catalog_days(spark, table, full_name)
    return _days_to_drop(lambda: spark.table(full_name), days, table, ttl, now)


def drop_expired(
    spark: SparkSession, table: str, full_name: str, ttl: timedelta, now: datetime
) -> list[date]:
    """Drop the expired day partitions of a catalog table; return the days."""
    days = expired_days(spark, table, full_name, ttl, now)
    for day in days:
        folder = day_folder(spark, table, full_name, day.isoformat())
        spark.sql(f"ALTER TABLE {full_name} DROP IF EXISTS {_partition(table, day.isoformat())}")
        Store(spark, folder).delete(folder)  # days that a stream added or a merge moved lie outside the catalog's care
    if days:
        spark.catalog.refreshTable(full_name)
    return days


def drop_expired_folders(
    spark: SparkSession, table: str, path: str, ttl: timedelta, now: datetime
) -> list[date]:
    """The same for a table that is a path only, such as a stream's target."""
    prefix = f"{spec_of(table).day}="
    store = Store(spark, path)
    names = [n.removeprefix(prefix) for n in store.folders(path) if n.startswith(prefix)]
    days = _days_to_drop(lambda: read_table(spark, table, path), names, table, ttl, now)
    for day in days:
        store.delete(f"{path}/{prefix}{day.isoformat()}")
    return days
