"""Ordered computations along a time series that do not need a whole series in one task.

A plain `Window.partitionBy(series)` sends every point of a series to one task;
one busy series can hold a third of a table. Here a series is cut into time
slices. Windows run per (series, slice), each slice leaves one summary row, and
only these summaries are ordered along the whole series. The summaries are then
joined back on (series, slice), the same hash partitioning the slice windows
already have, so the points are shuffled once.

The slice width is a trade: a task holds the points of a few (series, slice)
pairs, and the summaries of one series, one row per slice it has points in,
meet in one task. Ten minutes give some 50,000 summaries per series and year.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from signalbarn.functions.columns import div

DEFAULT_SLICE = timedelta(minutes=10)
_SLICE = "_slice"


def _sliced(df: DataFrame, time: str, width: timedelta) -> DataFrame:
    nanos = (width // timedelta(microseconds=1)) * 1000
    if nanos <= 0:
        raise ValueError("the slice width must be positive")
    return df.withColumn(_SLICE, div(time, nanos))


def previous_point(
    df: DataFrame,
    keys: list[str],
    time: str,
    order: list[str],
    values: list[str],
    name: str,
    slice_width: timedelta = DEFAULT_SLICE,
) -> DataFrame:
    """Add `name`: a struct of `values` of the row before, NULL for the first row.

    `order` starts with `time`; its other columns break ties. Keys are not NULL,
    as in all stored tables: a null-safe join would cost a second shuffle.
    """
    sliced = _sliced(df, time, slice_width)
    payload = F.struct(*values)
    rank = F.struct(*order)
    inside = Window.partitionBy(*keys, _SLICE).orderBy(*order)
    points = sliced.withColumn("_inside", F.lag(payload).over(inside))

    along = Window.partitionBy(*keys).orderBy(_SLICE)
    carried = (
        sliced.groupBy(*keys, _SLICE)
        .agg(F.max_by(payload, rank).alias("_tail"))
        .select(*keys, _SLICE, F.lag("_tail").over(along).alias("_carry"))
    )
    return (
        points.join(carried, [*keys, _SLICE], "left")
        .withColumn(name, F.coalesce("_inside", "_carry"))
        .drop("_inside", "_carry", _SLICE)
    )


def running_total(
    df: DataFrame,
    keys: list[str],
    time: str,
    order: list[str],
    value: str,
    name: str,
    first: dict[str, Column] | None = None,
    slice_width: timedelta = DEFAULT_SLICE,
) -> DataFrame:
    """Add `name`: the sum of `value` up to and including each row.

    `first` maps further column names to columns whose minimum over the whole
    series is added to every row.
    """
    first = first or {}
    sliced = _sliced(df, time, slice_width)
    inside = (
        Window.partitionBy(*keys, _SLICE)
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    points = sliced.withColumn("_inside", F.sum(value).over(inside))

    series = Window.partitionBy(*keys)
    before = series.orderBy(_SLICE).rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        sliced.groupBy(*keys, _SLICE)
        .agg(F.sum(value).alias("_total"), *[F.min(c).alias(n) for n, c in first.items()])
        .select(
            *keys,
            _SLICE,
            F.sum("_total").over(before).alias("_carry"),
            *[F.min(n).over(series).alias(n) for n in first],
        )
    )
    zero = F.lit(0)
    return (
        points.drop(*first)
        .join(carried, [*keys, _SLICE], "left")
        .withColumn(name, F.col("_inside") + F.coalesce("_carry", zero))
        .drop("_inside", "_carry", _SLICE)
    )
