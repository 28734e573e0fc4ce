"""Packing of token ids into sequences of fixed length: first-fit decreasing in randomised groups.

Documents are encoded where they are read and shuffled once, by the hash of id
and text, to groups of about `group_docs` documents; a row that repeats within a
task goes to another group each time, so that equal rows do not meet in one. A group cuts its documents
into whole sequences and a rest, and places the rests, longest first, each into
the first open sequence with room. A tournament tree holds the room of all
sequences: every node knows the most room below it, so the first fit is found
from the root down. Groups are independent; only the last sequences of a group
are padded much, so larger groups waste less.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalbarn.llm.common import tidy
from signalbarn.llm.tokens import encoder

LENGTH = 4096
GROUP_DOCS = 4096
MOST_PARTITIONS = 100_000
END_ID = 2

PACKED = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"


class RoomTree:
    """The first of `n` bins with enough room, in log n steps."""

    def __init__(self, n: int, room: int):
        self.size = 1
        while self.size < n:
            self.size *= 2
        self.room = [0] * self.size + [room] * n + [0] * (self.size - n)
        for i in range(self.size - 1, 0, -1):
            self.room[i] = max(self.room[2 * i], self.room[2 * i + 1])

    def place(self, need: int) -> tuple[int, int]:
        """Takes `need` from the first bin that has it: the bin and the room it had."""
        room, i = self.room, 1
        if room[1] < need:
            raise ValueError("no bin has so much room")
        while i < self.size:
            i *= 2
            if room[i] < need:
                i += 1
        had = room[i]
        room[i] -= need
        at = i
        while i > 1:
            i //= 2
            most = max(room[2 * i], room[2 * i + 1])
            if room[i] == most:
                break
            room[i] = most
        return at - self.size, had


def first_fit_decreasing(lengths: list[int], capacity: int) -> list[tuple[int, int]]:
    """(bin, offset) of each length; every length is at most `capacity`."""
    tree = RoomTree(max(1, len(lengths)), capacity)
    placed = [(0, 0)] * len(lengths)
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        b, had = tree.place(lengths[i])
        placed[i] = (b, capacity - had)
    return placed


def token_rows(docs: DataFrame, tokenizer: str, end_id: int = END_ID) -> DataFrame:
    """(doc_id, key, ids): each text's ids and the end id, as little-endian unsigned 32-bit integers.

    The key is a hash of the row, for a row that repeats in its task also of the
    task and the number of the repeat. Rows that are equal stay equal but for
    their keys, so a task that runs again gives the same rows, whatever their order.
    """

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        own = encoder(tokenizer)
        end = np.array([end_id], "<u4").tobytes()
        seen: Counter = Counter()

        def salted(key: int) -> int:
            n = seen[key] = seen[key] + 1
            return key if n == 1 else hash((key, part, n))  # hashes of whole numbers are the same everywhere

        for batch in batches:
            ids = [x + end for x in own.encode_many(batch["text"].tolist())]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "key": [salted(k) for k in batch["key"].tolist()], "ids": ids})
        tidy()

    keyed = docs.select("doc_id", F.xxhash64("doc_id", "text").alias("key"), "text")
    return keyed.mapInPandas(encode, "doc_id long, key long, ids binary")


def pack_documents(
    docs: DataFrame, tokenizer: str, length: int = LENGTH, group_docs: int = GROUP_DOCS, end_id: int = END_ID
) -> DataFrame:
    """One row per piece of a document of docs(doc_id, text), with its ids, sequence and place in it.

    Null and empty texts are their end id. Null ids are kept; repeated rows are
    documents of their own, dealt over the groups. An empty table gives no rows.
    Other columns are not read. A group is held in memory by one task.
    """
    groups = max(1, -(-docs.count() // group_docs))

    def pack(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["key", "doc_id"], kind="stable")
        ids = group["ids"].tolist()
        totals = [len(x) // 4 for x in ids]
        rests = [(i, n % length) for i, n in enumerate(totals) if n % length]
        placed = first_fit_decreasing([n for _, n in rests], length)
        bins = 1 + max((b for b, _ in placed), default=-1)
        rows = []
        for i, n in enumerate(totals):
            for start in range(0, n - n % length, length):
                rows.append((i, start, length, bins, 0))
                bins += 1
        rows += [(i, totals[i] - n, n, b, at) for (i, n), (b, at) in zip(rests, placed)]
        first = int(key[0]) << 32  # a group has fewer than 2 ** 32 sequences
        out = pd.DataFrame(rows, columns=["i", "start", "length", "sequence_id", "offset"])
        out["doc_id"] = group["doc_id"].astype("Int64").to_numpy()[out["i"]]
        out["doc_id"] = out["doc_id"].astype("Int64")
        out["doc_tokens"] = np.array(totals, np.int64)[out["i"]]
        out["sequence_id"] += first
        out["ids"] = [ids[i][4 * s : 4 * (s + n)] for i, s, n in zip(out["i"], out["start"], out["length"])]
        return out.drop(columns="i")[[c.split()[0] for c in PACKED.split(", ")]]

    grouped = token_rows(docs, tokenizer, end_id).withColumn("group", F.pmod("key", F.lit(groups)))
    # a partition holds a few groups, however many there are
    return grouped.repartition(min(groups, MOST_PARTITIONS), "group").groupBy("group").applyInPandas(pack, PACKED)


def piece_digests(packed: DataFrame) -> DataFrame:
    """The pieces with a crc32 in place of their ids."""
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
