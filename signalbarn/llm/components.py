"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalbarn.llm.common import small_or_shuffled, written

MAX_ROUNDS = 60


def _checksum(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """Rows (node, root): each node that has an edge, with the least node it is connected to.

    `edges` has two columns of the same type and links them without direction.
    Null ends and loops link nothing; repeated edges count once; without edges
    the result is empty. A node with very many edges is pre-aggregated before
    its minimum is shuffled. The minima are written before they are joined back:
    they are broadcast if counting shows them to be few, and otherwise both sides
    are plain shuffles, of which AQE splits the one with the busy node.
    """
    pairs = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a <> b").distinct()
    pairs = written(pairs, "edges")
    before = _checksum(pairs)
    if before[0]:
        for _ in range(MAX_ROUNDS):
            both = pairs.union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
            least = written(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), "minima")
            large = both.join(small_or_shuffled(least), "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
            down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b")
            down = written(down, "edges")
            least = written(down.groupBy("a").agg(F.min("b").alias("m")), "minima")
            small = down.join(small_or_shuffled(least), "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
            pairs = written(small.union(least).where("a <> b").distinct(), "edges")
            after = _checksum(pairs)
            if after == before:
                break
            before = after
        else:
            raise RuntimeError(f"components not stable after {MAX_ROUNDS} rounds")
    roots = pairs.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return pairs.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)
