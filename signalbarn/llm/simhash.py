"""SimHash near-duplicates, linked exactly through vantage-point trees.

Fingerprints are computed once per text. Equal ones collapse before anything is
compared, so large groups of copies cost one row. A vantage-point tree grown on
a bounded sample partitions the distinct fingerprints by Hamming distance: at
each node those within `radius` of the vantage point go inside, the others
outside. By the triangle inequality a link of at most `bits` bits that crosses
the border has its outer end within `radius + bits`; such outer ends are copied
inside, so both ends of every link meet in at least one shard. The tree's shape
follows the sample, never the result.

Inside a shard the same tree is grown on; at its leaves a search from
fingerprint to fingerprint visits each one once, so a shard gives at most one
edge per fingerprint, not one per pair. Components are then joined by
`connected_components`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalbarn.llm.common import document_key, written
from signalbarn.llm.components import connected_components

SEED = 42
#: Fingerprints that shape the tree of shards; bounds what the driver sees (8 bytes each).
SAMPLE = 1 << 18
#: Distinct fingerprints a shard should hold, as long as the sample can shape so many shards.
SHARD = 8192
#: Sampled fingerprints below which a node of the tree of shards is not split.
LEAST_SAMPLED = 16
#: Fingerprints below which a node inside a shard is searched without splitting.
LEAF = 1024
#: Shingles hashed at once, so that a very long text needs no more memory than its words.
CHUNK = 1 << 18


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """64 bits: each one set if it is set in over half of the hashes of the text's word shingles.

    Words are runs of bytes other than ASCII white space, with A-Z lower-cased.
    Fewer words than a shingle make one shingle; none give 0, as null does.
    """
    import xxhash

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    set_bits = np.zeros(64, np.int64)
    for start in range(0, n, CHUNK):
        part = words[start : min(start + CHUNK, n) + shingle - 1]
        grams = map(b" ".join, zip(*(part[i:] for i in range(shingle)))) if len(words) >= shingle else [b" ".join(words)]
        hashes = np.fromiter((xxhash.xxh64_intdigest(g, SEED) for g in grams), np.uint64)
        set_bits += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(set_bits * 2 > n, bitorder="little").tobytes(), "little")


def with_fingerprint(docs: DataFrame, text: str = "text", shingle: int = 3) -> DataFrame:
    """The column `fp` for each text, as a signed long with the fingerprint's 64 bits."""

    @F.pandas_udf("long")
    def fp(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series(np.array([fingerprint(t, shingle) for t in batch], np.uint64).view(np.int64))

    return docs.withColumn("fp", fp(F.col(text)))


# Trees: nodes are (vantage, radius, inside, outside); a leaf is its number.


def _split(points: np.ndarray, bits: int, tries: int = 4) -> tuple[np.uint64, int, np.ndarray] | None:
    """The vantage point, of a few, whose border copies the fewest points; None if none divides them well."""
    best = None
    for v in points[:: max(1, len(points) // tries)][:tries]:
        d = np.bitwise_count(points ^ v)
        radius = int(np.median(d))
        for r in {radius, max(radius - 1, 0)}:
            inside, copied = int((d <= r).sum()), int(((d > r) & (d <= r + bits)).sum())
            larger = max(inside + copied, len(points) - inside)
            if best is None or larger < best[0]:
                best = (larger, v, r, d)
    if best is None or best[0] > 0.9 * len(points):
        return None
    return best[1:]


def grow(sample: np.ndarray, leaves: int, bits: int):
    """A tree of about `leaves` leaves, as nested tuples, and their number."""
    made = 0

    def node(points: np.ndarray, want: float):
        nonlocal made
        cut = _split(points, bits) if want > 1 and len(points) >= LEAST_SAMPLED else None
        if cut is None:
            made += 1
            return made - 1
        v, radius, d = cut
        inside, outside = points[d <= radius], points[d > radius]
        return int(v), radius, node(inside, want / 2), node(outside, want / 2)

    tree = node(sample, float(leaves))
    return tree, made


def route(points: np.ndarray, tree, bits: int) -> list[tuple[int, np.ndarray]]:
    """(leaf, positions of the points in it). Points just outside a border are on both sides of it."""
    found, open_ = [], [(tree, np.arange(len(points)))]
    while open_:
        node, at = open_.pop()
        if not len(at):
            continue
        if isinstance(node, int):
            found.append((node, at))
            continue
        v, radius, inside, outside = node
        d = np.bitwise_count(points[at] ^ np.uint64(v))
        open_ += [(inside, at[d <= radius + bits]), (outside, at[d > radius])]
    return found


def _search(points: np.ndarray, at: np.ndarray, bits: int, edges: list) -> None:
    """Adds edges that connect what links connect among points[at]; each point is reached once."""
    rest = at
    while len(rest) > 1:
        root, rest = rest[0], rest[1:]
        front = np.array([root])
        while len(front) and len(rest):
            block, front = front[:64], front[64:]
            near = (np.bitwise_count(points[rest][:, None] ^ points[block][None, :]) <= bits).any(axis=1)
            if near.any():
                new, rest = rest[near], rest[~near]
                edges.append((np.full(len(new), root), new))
                front = np.concatenate([front, new])


def links(points: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges (positions) with the same components as all pairs of points at `bits` bits or fewer."""
    edges: list[tuple[np.ndarray, np.ndarray]] = []
    open_ = [np.arange(len(points))]
    while open_:
        at = open_.pop()
        cut = _split(points[at], bits) if len(at) > LEAF else None
        if cut is None:
            _search(points, at, bits, edges)
        else:
            _, radius, d = cut
            open_ += [at[d <= radius + bits], at[d > radius]]
    if not edges:
        return np.empty(0, int), np.empty(0, int)
    return np.concatenate([e[0] for e in edges]), np.concatenate([e[1] for e in edges])


def fingerprint_edges(prints: DataFrame, bits: int = 2) -> DataFrame:
    """Edges (a, b) between distinct fingerprints `fp`, with the components of all links of `bits` bits or fewer."""
    total = prints.count()
    part = max(1, -(-total // SAMPLE))
    # a sample by hash, so that a repeated run grows the same tree
    sampled = prints.where(F.pmod(F.xxhash64("fp"), F.lit(part)) == 0).orderBy(F.xxhash64("fp")).limit(SAMPLE)
    sample = np.array([r.fp for r in sampled.collect()], np.int64).view(np.uint64)
    tree, _ = grow(sample, max(1, total // SHARD), bits) if len(sample) else (0, 1)

    def shards(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            points = batch["fp"].to_numpy(np.int64)
            for leaf, at in route(points.view(np.uint64), tree, bits):
                yield pd.DataFrame({"shard": leaf, "fp": points[at]})

    def shard_links(group: pd.DataFrame) -> pd.DataFrame:
        points = np.sort(group["fp"].to_numpy(np.int64))
        a, b = links(points.view(np.uint64), bits)
        return pd.DataFrame({"a": points[a], "b": points[b]})

    routed = prints.mapInPandas(shards, "shard int, fp long")
    return routed.groupBy("shard").applyInPandas(shard_links, "a long, b long")


def simhash_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 3, bits: int = 2) -> DataFrame:
    """One row per row of `docs`: doc_id, fingerprint (16 hex digits), component_id, and the hashes of own and first text.

    Documents are linked if their fingerprints differ in at most `bits` bits;
    component_id is the smallest id among all that links lead to. Null and empty
    texts have fingerprint 0 and are linked like others. Repeated rows give
    repeated results. A null id keeps its row; component_id is null only if no
    document of the group has an id. component_id and first_hash together are
    the group's first document: the least id, nulls last, and of its texts the
    one with the least hash. Other columns are not read.
    """
    own = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    own = with_fingerprint(own, "text", shingle).withColumn("hash", document_key()["hash"])
    own = written(own.select("doc_id", "hash", "fp"), "fingerprints")
    order = F.struct(F.col("doc_id").isNull().alias("unnamed"), F.col("doc_id").alias("id"), F.col("hash"))
    least = own.groupBy("fp").agg(F.min(order).alias("least"))
    linked = connected_components(fingerprint_edges(least.select("fp"), bits), "a", "b")
    with_root = least.join(linked.withColumnRenamed("node", "fp"), "fp", "left")
    roots = with_root.where("root is not null").groupBy("root").agg(F.min("least").alias("of_root"))
    first = F.when(F.col("root").isNull(), F.col("least")).otherwise(F.col("of_root"))
    groups = with_root.join(roots, "root", "left").select(
        F.col("fp"), first["id"].alias("component_id"), first["hash"].alias("first_hash")
    )
    groups = written(groups, "groups")
    return own.join(groups, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "hash", "first_hash"
    )


def keep_first(docs: DataFrame, groups: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of `docs` for each group: its first document, once.

    Rows are told apart by id and text, so that an id with different texts
    stands for a document of each group that one of them is first in.
    """
    key = document_key(doc_id, text)
    is_first = F.col("doc_id").eqNullSafe(F.col("component_id")) & (F.col("hash") == F.col("first_hash"))
    gone = groups.where(~is_first).select(F.col("doc_id").alias("gone_id"), F.col("hash").alias("gone_hash")).distinct()
    kept = docs.join(gone, key["id"].eqNullSafe(F.col("gone_id")) & (key["hash"] == F.col("gone_hash")), "left_anti")
    if groups.where(is_first).groupBy("doc_id", "hash").count().where("count > 1").limit(1).count():
        # equal in id and text; the least of the other columns' hashes chooses, so that every run keeps the same row
        one = F.min_by(F.struct(*[F.col(f"`{c}`") for c in docs.columns]), F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns]))
        kept = kept.groupBy(key["id"].alias("key_id"), key["hash"].alias("key_hash")).agg(one.alias("row")).select("row.*")
    return kept
