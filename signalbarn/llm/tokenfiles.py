"""Token ids of whole texts in compressed binary files, in ascending order of doc_id.

Texts are range-partitioned by doc_id, and where one id has very many also by how
they begin, and encoded after the shuffle, once. Each task writes its range as files
of whole documents; a file's name starts with the number of its range, so names
sorted are documents sorted, and ends with the number of its ids. Reading lists the
files and deals out ranges of their blocks: a task decodes the documents that start
in its range, and behind it only what the last of them needs, from checkpoint to
checkpoint. Where each file's ids begin is told by the names before it.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from signalbarn.llm.files import opened, read_range, write_file
from signalbarn.llm.rans import BLOCK, TokenFile, encode_file
from signalbarn.llm.tokens import encoder

#: A file is closed at the first end of a document beyond so many ids.
FILE_IDS = 1 << 22
#: Words that a worker remembers, of each of two generations.
WORDS_HELD = 700_000
#: Blocks of a range that a task reads: a usual file, or part of a larger one. Each range reads the file's header.
RANGE_BLOCKS = 12
#: Rows of an id beyond which range partitioning also looks at so many characters of the texts.
BUSY_ID, TEXT_START = 10_000, 64
END_ID = 0


def write_token_files(
    docs: DataFrame,
    folder: str,
    tokenizer: str,
    end_id: int = END_ID,
    file_ids: int = FILE_IDS,
    partitions: int | None = None,
    busy_id: int = BUSY_ID,
) -> None:
    """Encodes docs(doc_id, text) into files under `folder`.

    Null texts are empty; each document ends with `end_id`. Null ids come first;
    repeated ids are documents of their own, ordered by text. A task holds one
    file's ids, 8 bytes each, at a time. Other columns are not read.
    """
    own = docs.select("doc_id", "text")
    order = [F.col("doc_id").asc_nulls_first(), F.col("text").asc_nulls_first()]
    most = own.groupBy("doc_id").count().agg(F.max("count")).first()[0] or 0
    # the bounds of ranges are drawn from a sample that the driver sees, so texts do not take part whole
    start = [F.substring("text", 1, TEXT_START).asc_nulls_first()] if most > busy_id else []
    ranged = own.repartitionByRange(*([partitions] if partitions else []), order[0], *start).sortWithinPartitions(*order)

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        encode = encoder(tokenizer, WORDS_HELD).encode_many
        end = np.array([end_id], "<u4").tobytes()
        part = TaskContext.get().partitionId()
        ids: list = []
        texts: list[np.ndarray] = []
        held = n = 0

        def close() -> pd.DataFrame:
            nonlocal held, n
            name = f"{part:06d}-{n:06d}.{held}.tok"
            write_file(f"{folder}/{name}", [encode_file(ids, texts)])
            out = pd.DataFrame({"name": [name], "documents": [len(ids)], "ids": [held]})
            ids.clear()
            texts.clear()
            held, n = 0, n + 1
            return out

        for batch in batches:
            for doc_id, coded in zip(batch["doc_id"].astype(object), encode(batch["text"].tolist())):
                ids.append(None if pd.isna(doc_id) else int(doc_id))
                texts.append(np.frombuffer(coded + end, "<u4"))
                held += len(texts[-1])
                if held >= file_ids:
                    yield close()
        if ids:
            yield close()

    # an aggregate makes every file without bringing their names to the driver
    ranged.mapInPandas(write, "name string, documents long, ids long").agg(F.sum("ids")).collect()


def _listed(folder: str) -> list[tuple[str, int]]:
    """Names of the files, in order, and how many ids each holds."""
    from pyarrow import fs

    system, path = opened(folder)
    files = system.get_file_info(fs.FileSelector(path, allow_not_found=True))
    names = sorted(f.base_name for f in files if f.base_name.endswith(".tok") and f.base_name[0] != ".")
    return [(name, int(name.split(".")[1])) for name in names]


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """A row per document of the files: doc_id, start, n_tokens and ids_crc32 of its ids.

    A file whose header tells another number of ids than its name fails the job.
    """

    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, ids, base, first, last in batch[["name", "ids", "base", "first", "last"]].itertuples(index=False):
                file = TokenFile.open(lambda start, n, name=name: read_range(f"{folder}/{name}", start, n))
                if sum(b["count"] for b in file.header["blocks"]) != ids:
                    raise ValueError(f"{name} does not hold {ids} ids")
                rows = [(doc_id, base + at, len(x), zlib.crc32(x)) for doc_id, at, x in file.documents_of(first, last)]
                out = pd.DataFrame(rows, columns=["doc_id", "start", "n_tokens", "ids_crc32"])
                out["doc_id"] = out["doc_id"].astype("Int64")
                yield out

    rows, before = [], 0
    for name, ids in _listed(folder):  # a name and a number per file of FILE_IDS ids
        blocks = -(-ids // BLOCK)
        rows += [(name, ids, before, b, min(b + RANGE_BLOCKS, blocks) - 1) for b in range(0, blocks, RANGE_BLOCKS)]
        before += ids
    ranges = spark.createDataFrame(rows, "name string, ids long, base long, first int, last int")
    ranges = ranges.repartition(max(1, min(len(rows), 65536)), "name", "first")
    return ranges.mapInPandas(decode, "doc_id long, start long, n_tokens long, ids_crc32 long")
