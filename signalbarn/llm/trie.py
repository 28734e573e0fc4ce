"""The prefix trie of conversations, with count-min screening of prefix digests.

A conversation's prefixes are told apart by digests: each turn's is made of the
digest before it and the turn's role and text, so texts never leave the scan. A
count-min sketch over all prefixes is at least the true count in every cell. An
estimate of one proves that a prefix belongs to one conversation, and so do all
that continue it: such tails become nodes where they are read. Only prefixes that
may be shared are shuffled and grouped, exactly, by digest.

What a node sums over its subtree is summed over conversations instead of levels.
Each node is owned by its smallest member; the nodes a conversation owns are the
end of its path. Its owner passes a node's share on to all prefixes of the path,
so one grouping by digest gives every subtree's total, however deep the trie is.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from signalbarn.llm.common import small_or_shuffled, written

#: Conversations of one family start like the family's first: the one whose id is the id less its remainder.
FAMILY, MOST_SHARED = 20, 4
#: Rows of the sketch, and the most cells of each (a byte a cell). Fuller sketches prove less and stay right.
SKETCH_ROWS, MOST_CELLS = 4, 1 << 24
#: Cells for each prefix, and the cells whose counts meet in one task.
CELLS_EACH, SLICE_CELLS = 4, 1 << 18
#: Digests a worker counts before it passes their cells on.
HELD_DIGESTS = 500_000
WORD = r"[^\x20\x09-\x0D]+"

_PATH = "conv_id long, depth long, d1 long, d2 long, p1 long, p2 long, f1 long, f2 long, words long, is_end boolean"
_DIGESTS = ["d1", "d2"]


def rebuilt_prefixes(turns: DataFrame, family: int = FAMILY, most_shared: int = MOST_SHARED) -> DataFrame:
    """The prefixes of rebuilt conversations: a row per conversation and depth, from depth 0 on.

    d1 and d2 are a prefix's digest, p1 and p2 its parent's, f1 and f2 that of
    the conversation's first turn; zero at depth 0. A family's turns are shuffled
    once, sorted by conversation, and read as a stream.
    """
    own = turns.where(F.col("conv_id").isNotNull())
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    said = F.unhex(F.sha2(F.concat_ws(":", F.length(role), F.concat(role, text)).cast("binary"), 256))
    base = F.col("conv_id") - F.col("conv_id") % family
    own = own.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        base.cast("long").alias("base"),
        "turn",
        F.substring(said, 1, 16).alias("said"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"),
        (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most_shared).cast("int").alias("shared"),
    )
    order = ["base", F.col("conv_id") != F.col("base"), "conv_id", F.col("turn").asc_nulls_first(), "said"]

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        family_of, first, conv, seen = None, [], None, 0
        node, last = None, None
        out: list[tuple] = []

        def step(said: bytes, words: int) -> None:
            nonlocal node, last
            out.append((*last, False))
            parent = node
            node = hashlib.blake2b(parent + said, digest_size=16).digest()
            depth = last[1] + 1
            last = (conv, depth, node, parent, node if depth == 1 else last[4], words)

        def frame() -> pd.DataFrame:
            raw = np.frombuffer(b"".join(r[2] + r[3] + r[4] for r in out), "<i8").reshape(-1, 6)
            table = {"conv_id": [r[0] for r in out], "depth": [r[1] for r in out]}
            table |= {c: raw[:, i] for i, c in enumerate(("d1", "d2", "p1", "p2", "f1", "f2"))}
            table |= {"words": [r[5] for r in out], "is_end": [r[6] for r in out]}
            out.clear()
            return pd.DataFrame(table)

        for batch in batches:
            for c, base, said, words, shared in zip(*(batch[x].tolist() for x in ("conv_id", "base", "said", "words", "shared"))):
                if c != conv:
                    if last:
                        out.append((*last, True))
                    if base != family_of:
                        family_of, first = base, []
                    conv, seen, node = c, 0, bytes(16)
                    last = (c, 0, node, node, node, 0)
                    if c != base:
                        for turn in first[:shared]:
                            step(*turn)
                seen += 1
                if c == base:
                    if len(first) < most_shared:
                        first.append((said, words))
                    step(said, words)
                elif seen > shared:
                    step(said, words)
            if out:
                yield frame()
        if last:
            out.append((*last, True))
            yield frame()

    return own.repartition("base").sortWithinPartitions(*order).mapInPandas(read, _PATH)


def _cells(hi: np.ndarray, lo: np.ndarray, width: int) -> np.ndarray:
    """The cell of each digest in each row of the sketch, rows one after another."""
    hi, lo = hi.astype(np.int64).view(np.uint64), lo.astype(np.int64).view(np.uint64)
    parts = [hi & np.uint64(0xFFFFFFFF), hi >> np.uint64(32), lo & np.uint64(0xFFFFFFFF), lo >> np.uint64(32)]
    return np.stack([(p.astype(np.int64) & (width - 1)) + i * width for i, p in enumerate(parts[:SKETCH_ROWS])])


def count_min(prefixes: DataFrame, width: int) -> np.ndarray:
    """The sketch of prefixes(d1, d2): SKETCH_ROWS * width counts that stay at 255. Its size is bounded by MOST_CELLS."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, n = [], 0

        def frame() -> pd.DataFrame:
            cells, counts = np.unique(np.concatenate(held), return_counts=True)
            cuts = np.flatnonzero(np.diff(cells // SLICE_CELLS)) + 1
            rows = [(int(c[0]) // SLICE_CELLS, c.astype("<u4").tobytes(), np.minimum(k, 255).astype("u1").tobytes()) for c, k in zip(np.split(cells, cuts), np.split(counts, cuts))]
            held.clear()
            return pd.DataFrame(rows, columns=["slice", "cells", "counts"])

        for batch in batches:
            if len(batch):
                held.append(_cells(batch["d1"].to_numpy(), batch["d2"].to_numpy(), width).ravel())
                n += len(batch)
            if n >= HELD_DIGESTS:
                yield frame()
                n = 0
        if held:
            yield frame()

    def merge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        number, counts = None, np.zeros(SLICE_CELLS, np.uint8)
        done = lambda: pd.DataFrame({"slice": [number], "table": [zlib.compress(counts.tobytes(), 1)]})
        for batch in batches:
            for s, cells, more in zip(batch["slice"], batch["cells"], batch["counts"]):
                if s != number:
                    if number is not None:
                        yield done()
                    number, counts = s, np.zeros(SLICE_CELLS, np.uint8)
                at = np.frombuffer(cells, "<u4") % SLICE_CELLS
                counts[at] = np.minimum(counts[at].astype(int) + np.frombuffer(more, "u1"), 255)
        if number is not None:
            yield done()

    parts = prefixes.select(*_DIGESTS).mapInPandas(count, "slice long, cells binary, counts binary")
    merged = parts.repartition("slice").sortWithinPartitions("slice").mapInPandas(merge, "slice long, table binary")
    sketch = np.zeros(max(SKETCH_ROWS * width, SLICE_CELLS), np.uint8)
    for r in merged.collect():  # at most SKETCH_ROWS * MOST_CELLS bytes
        sketch[r.slice * SLICE_CELLS : (r.slice + 1) * SLICE_CELLS] = np.frombuffer(zlib.decompress(r.table), np.uint8)[: len(sketch) - r.slice * SLICE_CELLS]
    return sketch


def screened(prefixes: DataFrame, width: int | None = None) -> DataFrame:
    """`prefixes` with alone (proven to belong to one conversation) and parent_alone; never true of a shared one."""
    n = prefixes.count()
    if width is None:
        width = min(MOST_CELLS, 1 << max(10, (CELLS_EACH * n - 1).bit_length()))
    deep = prefixes.where("depth > 0")
    sketch = prefixes.sparkSession.sparkContext.broadcast(count_min(deep, width))

    def mark(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = sketch.value
        for batch in batches:
            one = lambda a, b: table[_cells(batch[a].to_numpy(), batch[b].to_numpy(), width)].min(axis=0) == 1
            first = one("f1", "f2")
            parent = (first | one("p1", "p2")) & (batch["depth"].to_numpy() > 1)
            yield batch.assign(parent_alone=parent, alone=first | parent | one("d1", "d2"))

    return deep.mapInPandas(mark, f"{_PATH}, parent_alone boolean, alone boolean")


def end_digests(ends: DataFrame) -> DataFrame:
    """Rows (d1, d2, ends_sha256) of ends(d1, d2, conv_id): the hash of a node's sorted ids, read as a stream and never held."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        node, sha = None, None
        for batch in batches:
            out = []
            for d1, d2, c in zip(*(batch[x].tolist() for x in ("d1", "d2", "conv_id"))):
                if (d1, d2) == node:
                    sha.update(b",%d" % c)
                    continue
                if node:
                    out.append((*node, sha.hexdigest()))
                node, sha = (d1, d2), hashlib.sha256(b"%d" % c)
            yield pd.DataFrame(out, columns=["d1", "d2", "ends_sha256"])
        if node:
            yield pd.DataFrame([(*node, sha.hexdigest())], columns=["d1", "d2", "ends_sha256"])

    own = ends.select("d1", "d2", "conv_id").repartition("d1", "d2").sortWithinPartitions("d1", "d2", "conv_id")
    return own.mapInPandas(read, "d1 long, d2 long, ends_sha256 string")


def _sha(text: Column) -> Column:
    return F.sha2(text.cast("string").cast("binary"), 256)


def prefix_trie(turns: DataFrame, family: int = FAMILY, most_shared: int = MOST_SHARED, width: int | None = None) -> DataFrame:
    """One row per node of the trie of rebuilt conversations of turns(conv_id, turn, role, text).

    Turns go by `turn`, null first, ties by the SHA-256 of role and text; null
    roles and texts are empty ones; repeated rows are turns of their own. Rows
    without conv_id take no part, and without conversations there is no root.
    Other columns are not read. `width` is the number of cells of each row of the
    sketch, which follows the number of prefixes up to MOST_CELLS; it never
    changes the result. A conversation is read as a stream in one task.
    """
    prefixes = written(rebuilt_prefixes(turns, family, most_shared), "prefixes")
    marked = written(screened(prefixes, width), "screened")
    alone, maybe = marked.where("alone"), marked.where("not alone")

    nodes = maybe.groupBy("d1", "d2").agg(
        F.count("*").alias("n_convs"),
        F.min("conv_id").alias("conv_id"),
        F.max(F.when(F.col("is_end"), 0).otherwise(1)).alias("inner"),
        F.max("depth").alias("depth"),
        F.max("p1").alias("p1"),
        F.max("p2").alias("p2"),
        F.max("words").alias("words"),
    )
    nodes = written(nodes, "nodes")

    # what each conversation owns of the nodes on its path; the head of a tail owns itself and stands for the tail
    known = small_or_shuffled(nodes.select("d1", "d2", "n_convs", F.col("conv_id").alias("owner"), "inner"))
    rows = maybe.select("conv_id", "depth", "d1", "d2", "words", "is_end").join(known, _DIGESTS)
    owned = F.col("owner") == F.col("conv_id")
    rows = rows.select(
        "conv_id",
        "depth",
        "d1",
        "d2",
        F.when(owned, 1).otherwise(0).alias("owned"),
        F.when(owned, (F.col("n_convs") - 1) * F.col("words")).otherwise(0).alias("gain"),
        F.when(owned & F.col("is_end") & (F.col("inner") == 0), 1).otherwise(0).alias("leaf"),
    )
    heads = alone.where("not parent_alone and depth > 1")
    told = heads.select("conv_id", "depth", "d1", "d2", F.lit(1).alias("owned"), F.lit(0).cast("long").alias("gain"), F.lit(1).alias("leaf"))
    path = Window.partitionBy("conv_id").orderBy(F.col("depth").desc())
    below = path.rowsBetween(Window.unboundedPreceding, 0)
    shares = rows.withColumn("of_tail", F.lit(False)).union(told.withColumn("of_tail", F.lit(True)))
    shares = shares.select(
        "conv_id",
        "d1",
        "d2",
        "of_tail",
        F.coalesce(F.lag("owned").over(path), F.lit(0)).alias("child"),
        F.max("leaf").over(below).alias("leaf"),
        F.sum("gain").over(below).alias("saved"),
    )
    sums = shares.where("not of_tail").groupBy("d1", "d2")
    sums = sums.agg(F.sum("child").alias("n_children"), F.sum("leaf").alias("n_leaves"), F.sum("saved").alias("saved_tokens"))

    inner = written(nodes.join(sums, _DIGESTS), "inner")
    root = _root(prefixes, alone, inner)
    if root is None:
        return turns.sparkSession.createDataFrame([], _COLUMNS)
    parents = small_or_shuffled(nodes.select(F.col("d1").alias("p1"), F.col("d2").alias("p2"), F.col("conv_id").alias("parent")))
    parent = F.when(F.col("depth") == 1, root["conv_id"]).otherwise(F.coalesce("parent", "conv_id"))
    empty = hashlib.sha256(b"").hexdigest()

    def tails(df: DataFrame, parent: Column) -> DataFrame:
        return df.select(
            "conv_id",
            "depth",
            parent.alias("parent_conv_id"),
            F.lit(1).alias("n_convs"),
            F.when(F.col("is_end"), 0).otherwise(1).alias("n_children"),
            F.lit(1).alias("n_leaves"),
            F.lit(0).alias("saved_tokens"),
            F.when(F.col("is_end"), _sha(F.col("conv_id"))).otherwise(empty).alias("ends_sha256"),
        )

    known_parent = F.when(F.col("depth") == 1, root["conv_id"]).otherwise(F.col("conv_id"))
    local = tails(alone.where("parent_alone or depth = 1"), known_parent)
    joined = tails(heads.join(parents, ["p1", "p2"], "left"), parent)
    shared = inner.join(end_digests(maybe.where("is_end")), _DIGESTS, "left").join(parents, ["p1", "p2"], "left")
    shared = shared.select(
        "conv_id", "depth", parent.alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(empty)).alias("ends_sha256")
    )
    # conversations without turns end at the root; without any, the hash of nothing is what is left
    told = end_digests(prefixes.where("depth = 0 and is_end")).select("ends_sha256", F.lit(1).alias("is_told"))
    ends = told.union(turns.sparkSession.range(1).select(F.lit(empty), F.lit(0)))
    numbers = [F.lit(root[c]).cast("long").alias(c) for c in ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")]
    top = ends.agg(F.max_by("ends_sha256", "is_told").alias("ends_sha256")).select(*numbers, "ends_sha256")
    out = local.union(joined).union(shared).union(top)
    return out.select(*[F.col(c).cast(kind).alias(c) for c, kind in (x.split() for x in _COLUMNS.split(", "))])


_COLUMNS = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"


def _root(prefixes: DataFrame, alone: DataFrame, inner: DataFrame) -> dict | None:
    """The textless node's numbers, from sums over the nodes below it; None without conversations."""
    top = prefixes.where("depth = 0").agg(F.count("*").alias("n"), F.min("conv_id").alias("first")).first()
    if not top["n"]:
        return None
    single = alone.where("depth = 1").count()
    shared = inner.where("depth = 1").agg(F.count("*").alias("n"), F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved")).first()
    return {
        "conv_id": top["first"],
        "depth": 0,
        "parent_conv_id": None,
        "n_convs": top["n"],
        "n_children": single + shared["n"],
        "n_leaves": max(1, single + (shared["leaves"] or 0)),
        "saved_tokens": shared["saved"] or 0,
    }
