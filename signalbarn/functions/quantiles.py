"""Exact discrete quantiles of whole-number values per group, safe for hot groups.

The built-in `percentile_disc` keeps all distinct values of a group in one
task. Here rows are counted in coarse value ranges (a few thousand per group,
whatever its size), the range holding each rank is found on these counts, and
the values of that one range are counted. These counts are refined once more:
summed by parts of the range, whose number is bounded too, until one part of it
is left. Only the distinct values of that part are ordered, some millionth of
the value's size, so a range that holds a great share of a group is not put into
one task either. The answer is the one `percentile_disc` gives.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Ranges per doubling of the value: each is about 0.07 % wide.
_RANGES_PER_OCTAVE = 1024
# Parts of a range, about.
_PARTS = 1024


def value_range(value: Column) -> Column:
    """Order-preserving coarse range of a non-negative whole number.

    Only the order matters: a larger value never gets a smaller range, since
    rounding and Java's logarithm never swap two numbers.
    """
    octaves = F.log2(value.cast("double") + 1.0)
    return F.floor(octaves * _RANGES_PER_OCTAVE).cast("bigint")


def part_of_range(value: Column, value_range: Column) -> Column:
    """Order-preserving part of the range a value lies in: whole numbers of one width within a range."""
    start = F.pow(F.lit(2.0), value_range / _RANGES_PER_OCTAVE)
    width = start * (2.0 ** (1.0 / _RANGES_PER_OCTAVE) - 1.0) / _PARTS
    return F.call_function("div", value, F.greatest(F.floor(width).cast("bigint"), F.lit(1).cast("bigint")))


def exact_quantiles(
    df: DataFrame,
    by: list[str],
    value: str,
    quantiles: dict[str, str],
    extra: dict[str, tuple[Column, Column]] | None = None,
) -> DataFrame:
    """One row per group: `by`, the requested quantiles and the `extra` aggregates.

    `quantiles` maps result names to decimal texts such as "0.95", so that ranks
    are exact. `value` must be a non-negative BIGINT; NULL values are not ranked.
    `extra` maps a name to (partial, merge): `partial` is an aggregate over input
    rows, `merge` an aggregate over the column of that name. They ride along on
    the same scan and shuffles.
    """
    extra = extra or {}
    # NULL values form a range of their own below all others, with no weight.
    # A struct is a plain join key also where its fields are NULL.
    ranged = df.withColumns(
        {
            "_range": F.coalesce(value_range(F.col(value)), F.lit(-1)),
            "_group": F.struct(*by),
        }
    )

    # Coarse counts: a few thousand rows per group, combined on the map side.
    ranges = ranged.groupBy("_group", "_range").agg(
        F.count(value).alias("_n"), *[p.alias(n) for n, (p, _) in extra.items()]
    )
    group = Window.partitionBy("_group")
    placed = ranges.withColumns(
        {
            "_upto": F.sum("_n").over(group.orderBy("_range")),
            "_all": F.sum("_n").over(group),
        }
    )

    def rank(q: str) -> Column:
        exact = F.ceil(F.lit(q).cast("decimal(10,9)") * F.col("_all").cast("decimal(20,0)"))
        return F.greatest(exact.cast("bigint"), F.lit(1))

    def target(q: str) -> Column:
        """The range that holds the rank, and the rank inside that range."""
        inside = rank(q) - (F.col("_upto") - F.col("_n"))
        hit = F.struct(F.col("_range").alias("range"), inside.alias("rank"))
        nothing = F.struct(F.lit(-1).cast("bigint").alias("range"), F.lit(0).cast("bigint").alias("rank"))
        return F.coalesce(F.min(F.when(F.col("_upto") >= rank(q), hit)), nothing)

    groups = placed.groupBy("_group").agg(
        *[target(q).alias(f"_at_{name}") for name, q in quantiles.items()],
        *[m.alias(n) for n, (_, m) in extra.items()],
    )
    wanted = groups.select(
        "_group",
        *extra,
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(name).alias("_name"),
                        F.col(f"_at_{name}.range").alias("_range"),
                        F.col(f"_at_{name}.rank").alias("_rank"),
                    )
                    for name in quantiles
                ]
            )
        ),
    )

    # Only rows of wanted ranges are counted by value.
    keys = ["_group", "_range"]
    narrowed = ranged.select(*keys, value).join(wanted, keys)
    target = [*keys, "_name", "_rank", *extra]
    counted = narrowed.groupBy(*target, value).agg(F.count(value).alias("_n"))
    counted = counted.withColumn("_part", F.coalesce(part_of_range(F.col(value), F.col("_range")), F.lit(-1)))

    # The part that holds the rank: at most some thousand sums per rank are ordered.
    sums = counted.groupBy(*target, "_part").agg(F.sum("_n").alias("_n"))
    along = Window.partitionBy(*keys, "_name").orderBy("_part")
    placed_parts = sums.withColumn("_upto", F.sum("_n").over(along)).filter(F.col("_upto") >= F.col("_rank"))
    first = placed_parts.withColumn("_at", F.row_number().over(along)).filter(F.col("_at") == 1)
    parts = first.select(
        *keys, "_name", "_part", *extra, (F.col("_rank") - F.col("_upto") + F.col("_n")).alias("_rank")
    )

    # The value inside that part.
    values = counted.select(*keys, "_name", "_part", value, "_n").join(parts, [*keys, "_name", "_part"])
    inside = Window.partitionBy(*keys, "_name", "_part").orderBy(value)
    return (
        values.withColumn("_upto", F.sum("_n").over(inside))
        .filter(F.col("_upto") >= F.col("_rank"))
        .groupBy("_group")
        .agg(
            *[F.max(n).alias(n) for n in extra],
            *[F.min(F.when(F.col("_name") == n, F.col(value))).alias(n) for n in quantiles],
        )
        .select(*[F.col(f"_group.{c}").alias(c) for c in by], *extra, *quantiles)
    )
