"""Hard negatives by a secondary sort: pair scores in keys, windows opened while the sorted keys stream by.

Rows are dealt to shards and anchors to blocks; a task scores one shard against
one block. A first pass keeps each anchor's best rows of its own label, its
positives. The second pass looks, for each positive, at the rows of other labels
whose score lies in the positive's window, and passes on the first few of its
shard: no other row can be among the first few of all. Positives and these
candidates are packed into keys

    anchor, descending score, id

which are repartitioned by anchor and sorted within partitions. The reader of a
partition opens a window at each positive and hands out the negatives that
follow; it holds an anchor's open windows and never its rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from signalbarn.llm.common import written

#: Components are scores' units: floor(SCALE * x).
SCALE = 256
#: A negative's score lies between these tenths of its positive's.
LEAST_TENTHS, MOST_TENTHS = 3, 9
POSITIVES, NEGATIVES = 5, 10
#: Rows of a shard, between LEAST_SHARD for small tables and SHARD_ROWS, and anchors of a block.
LEAST_SHARD, SHARD_ROWS, BLOCK_ANCHORS = 1024, 8192, 1024
#: Anchors whose scores against a shard are held at once.
HELD_ANCHORS = 128
_MOST = 2**63 - 1
_RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def usable(vector: Column) -> Column:
    """Whether a vector takes part: not null, and neither are its components, which are finite."""
    return F.coalesce(F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))), F.lit(False))


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of the rows of two matrices of whole numbers, exact; beyond 64 bits they stay at the limit."""
    size = a.shape[1]
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(1, size)
    if most < 2**53:
        return (a @ b.T).astype(np.int64)
    whole = [[int(x) for x in row] for row in b]
    sums = [[sum(x * y for x, y in zip(row, other)) for other in whole] for row in ([int(x) for x in r] for r in a)]
    return np.array([[max(-_MOST, min(_MOST, s)) for s in row] for row in sums], np.int64).reshape(len(a), len(b))


def window_of(positive: int) -> tuple[int, int]:
    """The least and the greatest score of a positive's negatives; empty below zero."""
    return -(-LEAST_TENTHS * positive // 10), MOST_TENTHS * positive // 10


def _by_anchor(held: pd.DataFrame, block: pd.DataFrame) -> Iterator[tuple]:
    """(row of block, ids, labels, scores) of each anchor against the rows with as many components, by ascending id."""
    held = held.sort_values("vec_id", kind="stable")
    sizes, asked = held["embedding"].str.len().to_numpy(), block["embedding"].str.len().to_numpy()
    for size in np.intersect1d(sizes, asked):
        rows = held[sizes == size]
        ids, labels = rows["vec_id"].to_numpy(np.int64), rows["label"].to_numpy(np.int64)
        units = lambda v: np.floor(SCALE * np.stack(v.to_list()).astype(float).reshape(len(v), size))
        matrix, mine = units(rows["embedding"]), block[asked == size]
        for at in range(0, len(mine), HELD_ANCHORS):
            part = mine.iloc[at : at + HELD_ANCHORS]
            for anchor, scores in zip(part.itertuples(), products(units(part["embedding"]), matrix)):
                yield anchor, ids, labels, scores


def _best(scores: np.ndarray, n: int) -> np.ndarray:
    """Positions of the n greatest scores, first ones first among equals."""
    if len(scores) > 4 * n:
        least = np.partition(scores, len(scores) - n)[len(scores) - n]
        at = np.concatenate([np.flatnonzero(scores > least), np.flatnonzero(scores == least)[:n]])
    else:
        at = np.arange(len(scores))
    return at[np.lexsort((at, -scores[at]))][:n]


def _frame(parts: list, columns: str) -> pd.DataFrame:
    names = [c.split()[0] for c in columns.split(", ")]
    return pd.DataFrame({c: np.concatenate([p[i] for p in parts]) if parts else np.empty(0, np.int64) for i, c in enumerate(names)})


def _cells(rows: DataFrame, anchors: DataFrame, shards: int, blocks: int):
    """Each shard of rows with each block of anchors, as a cogroup."""
    number = lambda n: F.pmod(F.xxhash64("vec_id", "label", "embedding"), F.lit(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    rows = rows.withColumn("shard", number(shards)).withColumn("block", each(blocks))
    anchors = anchors.withColumn("block", number(blocks)).withColumn("shard", each(shards))
    tasks = shards * blocks  # a number of its own, so that small cells are not put into a few tasks
    rows, anchors = (x.withColumn("cell", F.col("shard") * blocks + F.col("block")).repartition(tasks, "cell") for x in (rows, anchors))
    return rows.groupBy("cell").cogroup(anchors.groupBy("cell"))


def best_of_label(rows: DataFrame, anchors: DataFrame, positives: int, shards: int, blocks: int) -> DataFrame:
    """Rows (anchor_id, anchor_key, vec_id, score): the first `positives` other rows of each anchor's label."""
    columns = "anchor_id long, anchor_key long, vec_id long, score long"

    def cell(held: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        parts = []
        for anchor, ids, labels, scores in _by_anchor(held, block):
            mine = np.flatnonzero((labels == anchor.label) & (ids != anchor.vec_id))
            mine = mine[_best(scores[mine], positives)]
            parts.append([np.full(len(mine), anchor.vec_id), np.full(len(mine), anchor.key), ids[mine], scores[mine]])
        return _frame(parts, columns)

    found = _cells(rows, anchors, shards, blocks).applyInPandas(cell, columns)
    order = Window.partitionBy("anchor_id", "anchor_key").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("n", F.row_number().over(order)).where(F.col("n") <= positives).drop("n")


def in_windows(rows: DataFrame, anchors: DataFrame, negatives: int, shards: int, blocks: int) -> DataFrame:
    """Rows (anchor_id, anchor_key, vec_id, score): of each shard, the first `negatives` in each window of an anchor's `scores`."""
    columns = "anchor_id long, anchor_key long, vec_id long, score long"

    def cell(held: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        parts = []
        for anchor, ids, labels, scores in _by_anchor(held, block):
            other = labels != anchor.label
            taken = np.zeros(len(ids), bool)
            for positive in {int(s) for s in anchor.scores}:
                low, high = window_of(positive)
                inside = np.flatnonzero(other & (scores >= low) & (scores <= high))
                taken[inside[_best(scores[inside], negatives)]] = True
            mine = np.flatnonzero(taken)
            parts.append([np.full(len(mine), anchor.vec_id), np.full(len(mine), anchor.key), ids[mine], scores[mine]])
        return _frame(parts, columns)

    return _cells(rows, anchors, shards, blocks).applyInPandas(cell, columns)


def packed(pairs: DataFrame) -> DataFrame:
    """`pairs` as rows (key, positive): bytes that sort by anchor, descending score and id."""

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            parts = np.empty((len(batch), 4), ">u8")
            for i, c in enumerate(("anchor_id", "anchor_key", "score", "vec_id")):
                signed = batch[c].to_numpy(np.int64)
                # flipping the sign bit puts signed numbers in order; flipping all bits turns the order round
                parts[:, i] = (~signed if c == "score" else signed).view(np.uint64) ^ np.uint64(1 << 63)
            keys = parts.tobytes()
            yield pd.DataFrame({"key": [keys[at : at + 32] for at in range(0, len(keys), 32)], "positive": batch["positive"]})

    return pairs.mapInPandas(pack, "key binary, positive boolean")


def stream_windows(keys: DataFrame, negatives: int = NEGATIVES) -> DataFrame:
    """The result rows from packed keys, by one pass over sorted partitions."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        anchor, windows, zeros = None, [], []
        for batch in batches:
            raw = np.frombuffer(b"".join(batch["key"]), ">u8").reshape(-1, 4).astype(np.uint64) ^ np.uint64(1 << 63)
            numbers, out = raw.view(np.int64), []
            numbers[:, 2] = ~numbers[:, 2]
            for (a, k, score, vec_id), positive in zip(numbers.tolist(), batch["positive"].tolist()):
                if (a, k) != anchor:
                    anchor, windows, zeros = (a, k), [], []
                if positive:
                    windows.append(w := [vec_id, score, *window_of(score), 0])
                    asked, given = [w], zeros if score == 0 else []
                else:
                    asked, given = windows, [(vec_id, score)]
                    if score == 0 and len(zeros) < negatives:  # a positive of zero may follow its negatives
                        zeros.append((vec_id, score))
                for w in asked:
                    for n, s in given:
                        if w[2] <= s <= w[3] and w[4] < negatives:
                            w[4] += 1
                            out.append((a, w[0], w[4], n, w[1], s))
            yield pd.DataFrame(out, columns=[c.split()[0] for c in _RESULT.split(", ")])

    by_anchor = keys.repartition(F.substring("key", 1, 16)).sortWithinPartitions("key")
    return by_anchor.mapInPandas(read, _RESULT)


def hard_negatives(
    rows: DataFrame, anchors: Column, positives: int = POSITIVES, negatives: int = NEGATIVES, shard_rows: int = SHARD_ROWS, block_anchors: int = BLOCK_ANCHORS
) -> DataFrame:
    """For each anchor and each of its positives, the first negatives of the positive's window.

    `rows` are (vec_id, label, embedding), `anchors` tells which of them are
    anchors. An anchor's positives are the other rows of its label with the
    greatest scores, its negatives rows of other labels whose score is between
    LEAST_TENTHS and MOST_TENTHS tenths of the positive's. A score is the inner
    product of the components' floor(SCALE * x); ties go to the smaller id. Rows
    without id or label, and those that are not usable(), take no part; rows with
    another number of components than the anchor are not its candidates. Equal
    rows count once; different rows of one id are anchors and candidates of their
    own, but never candidates of their own id. Scores beyond 64 bits stay at the
    limit. Other columns are not read, an empty table gives no rows.
    """
    own = rows.select("vec_id", F.col("label").cast("long").alias("label"), "embedding")
    own = own.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & usable(F.col("embedding")))
    own = written(own.distinct(), "vectors")
    asked = written(own.where(anchors).withColumn("key", F.xxhash64("label", "embedding")), "anchors")
    total, n = own.count(), asked.count()
    shards = max(1, -(-total // min(shard_rows, max(LEAST_SHARD, total // 64))))
    blocks = max(1, -(-n // block_anchors))
    best = written(best_of_label(own, asked, positives, shards, blocks), "positives")
    scores = best.groupBy(F.col("anchor_id").alias("vec_id"), F.col("anchor_key").alias("key")).agg(F.collect_list("score").alias("scores"))
    opened = asked.join(scores, ["vec_id", "key"]).select("vec_id", "label", "embedding", "key", "scores")
    near = in_windows(own, opened, negatives, shards, blocks)
    pairs = best.withColumn("positive", F.lit(True)).union(near.withColumn("positive", F.lit(False)))
    return stream_windows(packed(pairs), negatives)
