"""Nearest neighbours by collision counting, with query-centred windows and virtual rehashing.

Vectors are dealt to shards by hash, queries to blocks; each task holds one shard
and one block. A shard keeps one sorted array per random projection. A query
opens a window around its own projection in every array and counts, for each
vector, in how many windows it lies. Windows widen round by round (virtual
rehashing: no table is built again), and only the newly covered ends are
counted. Vectors that reach the collision threshold are verified on their
original values. A query ends when its windows are so wide that a vector as far
away as its k-th best would by now have reached the threshold.

Largest inner products become smallest distances by one more coordinate that
gives all vectors of a shard one length. Equal vectors of a shard count once and
keep their smallest ids.
"""

from __future__ import annotations

import math
import sys
from collections import Counter
from fractions import Fraction
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from signalbarn.llm.common import written

PROJECTIONS = 32
#: Share of the windows that a vector must lie in to be verified.
THRESHOLD = 0.57
#: Standard deviations by which an equally distant vector would be expected beyond the threshold when a query ends.
MARGIN = 2.0
#: Windows widen by this factor from round to round; the first one's half width is this share of the vectors' length.
WIDEN, FIRST = 1.4, 0.2
#: Windows end at marks this far apart, as a share of the vectors' length.
MARK = 0.01
SHARD_ROWS, BLOCK_ROWS = 16384, 1024
SEED = 7


def exact_product(a: np.ndarray, b: np.ndarray) -> float:
    """The inner product, correctly rounded whatever the order of its terms; beyond doubles it stays at their limit."""
    try:
        with np.errstate(over="ignore"):
            found = math.fsum((a * b).tolist())
        if math.isfinite(found):
            return found
    except (OverflowError, ValueError):  # infinite terms, or partial sums that are
        pass
    whole = sum(Fraction(x) * Fraction(y) for x, y in zip(a.tolist(), b.tolist()))
    most = Fraction(sys.float_info.max)
    return float(max(-most, min(most, whole)))


def _largest(x: np.ndarray) -> float:
    return float(np.abs(x).max(initial=0)) or 1.0


class CollisionIndex:
    """Sorted projections of distinct vectors of one dimension."""

    def __init__(self, vectors: np.ndarray, projections: int = PROJECTIONS, seed: int = SEED):
        # in parts of the largest component, so that neither squares nor sums leave the doubles
        self.vectors = vectors = vectors / _largest(vectors)
        norms = (vectors * vectors).sum(axis=1)
        self.length = float(np.sqrt(norms.max())) if len(vectors) else 1.0
        lifted = np.column_stack([vectors, np.sqrt(np.maximum(self.length**2 - norms, 0))]) / self.length
        rng = np.random.default_rng([seed, vectors.shape[1]])
        self.axes = rng.standard_normal((lifted.shape[1], projections))
        places = lifted @ self.axes
        order = np.argsort(places, axis=0, kind="stable")
        self.order = np.ascontiguousarray(order.T)
        self.limit = float(np.abs(places).max()) + 2 * MARK
        marks = np.arange(-self.limit, self.limit + MARK, MARK)
        #: How many vectors lie before each mark, by projection.
        self.before = np.stack([np.searchsorted(p, marks) for p in np.take_along_axis(places, order, axis=0).T])
        self.need = math.ceil(THRESHOLD * projections)
        p = min(0.99, THRESHOLD + MARGIN * math.sqrt(THRESHOLD * (1 - THRESHOLD) / projections))
        #: Half width of a window over the distance of a vector that collides with probability p.
        self.reach = NormalDist().inv_cdf((1 + p) / 2)

    def _near(self, at: np.ndarray, products: np.ndarray, k: int, norm: float) -> tuple[np.ndarray, np.ndarray]:
        """The k best of the verified vectors, and those that may be as good."""
        if len(at) > k:
            kth = np.partition(products, len(products) - k)[len(products) - k]
            near = products >= kth - 1e-9 * max(1.0, self.length * norm)
            at, products = at[near], products[near]
        return at, products

    def search(self, query: np.ndarray, k: int, exact: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """Positions and approximate products of the best vectors: k, or more if more tie or are verified alike.

        With `exact` every vector is verified, without windows.
        """
        n, m = len(self.vectors), len(self.order)
        query = query / _largest(query)
        norm = float(np.sqrt((query * query).sum()))
        if exact:
            return self._near(np.arange(n), self.vectors @ query, k, norm)
        centre = np.append(query / norm, 0.0) @ self.axes
        each, last = np.arange(m), self.before.shape[1] - 1

        def upto(edge: np.ndarray) -> np.ndarray:
            mark = np.clip(np.rint((edge + self.limit) / MARK), 0, last).astype(np.int64)
            return self.before[each, mark]

        low = high = upto(centre)
        counts = np.zeros(n, np.int64)
        verified = np.zeros(n, bool)
        at, products = np.empty(0, np.int64), np.empty(0)
        half = FIRST
        while True:
            left, right = upto(centre - half), upto(centre + half)
            ends = [self.order[i, a:b] for i in range(m) for a, b in ((left[i], low[i]), (high[i], right[i]))]
            counts += np.bincount(np.concatenate(ends), minlength=n)
            low, high = left, right
            new = np.flatnonzero((counts >= self.need) & ~verified)
            if len(new):
                verified[new] = True
                at = np.concatenate([at, new])
                products = np.concatenate([products, self.vectors[new] @ query])
            if len(at) >= n:
                break
            if len(at) >= k:
                kth = np.partition(products, len(products) - k)[len(products) - k]
                distance = math.sqrt(max(0.0, 2 - 2 * kth / (self.length * norm)))
                if half >= self.reach * distance:
                    break
            half *= WIDEN
        return self._near(at, products, k, norm)


def usable(vector: Column) -> Column:
    """Whether a vector takes part: not null, not zero, and all its components finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def nearest(
    vectors: DataFrame, every: int = 20, k: int = 20, shard_rows: int = SHARD_ROWS, block_rows: int = BLOCK_ROWS, exact: bool = False
) -> DataFrame:
    """The k nearest vectors of each query of vectors(vec_id, embedding): query_id, rank, vec_id, score.

    Queries are rows whose id is divisible by `every`; candidates are all rows
    with another id and as many components. The score is the inner product in
    double precision of the original vectors; ties go to the smaller id. Rows
    that are not usable() or without id take no part; of rows that repeat an id,
    the same vector counts once and different ones are candidates of their own.
    A query without candidates gives no row. Other columns are not read. The
    result may miss some neighbours (README has the measured recall); `exact`
    verifies every vector instead and misses none.
    """
    own = vectors.select("vec_id", "embedding").where(F.col("vec_id").isNotNull() & usable(F.col("embedding").cast("array<double>")))
    # equal rows count once: copies of one row take no places of other ids, and do not fill a shard
    own = written(own.distinct(), "vectors").withColumn("embedding", F.col("embedding").cast("array<double>"))
    queries = own.where(F.col("vec_id") % every == 0)
    total, asked = own.count(), queries.count()
    shards, blocks = max(1, -(-total // shard_rows)), max(1, -(-asked // block_rows))
    number = lambda n: F.pmod(F.xxhash64("vec_id", "embedding"), F.lit(n)).cast("int")
    data = own.withColumn("shard", number(shards)).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    asked_of = queries.withColumn("block", number(blocks)).withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))

    def search(key: tuple, held: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        rows = []
        held_ids, held_vectors = held["vec_id"].to_numpy(np.int64), held["embedding"].tolist()
        sizes = np.array([len(v) for v in held_vectors], np.int64)
        asked = sorted(zip(block["vec_id"].tolist(), map(np.asarray, block["embedding"])), key=lambda q: (len(q[1]), q[0]))
        for size in sorted({len(v) for _, v in asked} & set(sizes.tolist())):
            mine = np.flatnonzero(sizes == size)
            found, of = np.unique(np.stack([held_vectors[i] for i in mine]), axis=0, return_inverse=True)
            of = of.reshape(-1)
            by = np.lexsort((held_ids[mine], of))
            ids, first = held_ids[mine][by], np.searchsorted(of[by], np.arange(len(found) + 1))
            vectors_of = Counter(ids.tolist())
            index = CollisionIndex(found)
            for query_id, query in asked:
                if len(query) != size:
                    continue
                # none of the query's own vectors may take a candidate's place
                at, _ = index.search(query, k + max(1, vectors_of[query_id]), exact)
                best = []
                for i in at:
                    product = exact_product(found[i], query)
                    # a vector and its copies: k + 1 of the smallest ids are enough, one may be the query's own
                    same = dict.fromkeys(ids[first[i] : min(first[i + 1], first[i] + k + 1)].tolist())
                    best += [(-product, j) for j in same if j != query_id]
                rows += [(query_id, j, -product) for product, j in sorted(best)[:k]]
        return pd.DataFrame(rows, columns=["query_id", "vec_id", "score"])

    found = (
        data.groupBy("shard", "block")
        .cogroup(asked_of.groupBy("shard", "block"))
        .applyInPandas(search, "query_id long, vec_id long, score double")
        .distinct()
    )
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
