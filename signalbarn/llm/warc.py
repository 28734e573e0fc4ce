"""WARC archives: one gzip member per record, written by tasks and read back by byte ranges.

A record whose payload other records share is a response if it has the smallest
id of them, else a revisit that points to it. Who revisits whom is settled on
digests alone; pages then meet their verdict by page id, so that payloads are
shuffled once and by a key without hot values.

The reader cuts archives into byte ranges. A task looks for gzip's magic bytes in
its range, takes a place as a member's start only if the bytes from there
inflate to a record's version line and headers, and owns the records that start
inside its range; it reads on beyond the range's end to finish the last one.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from signalbarn.llm.common import small_or_shuffled, written
from signalbarn.llm.files import opened, write_file

#: A file is closed beyond so many bytes; ranges are of this size.
FILE_BYTES = 64 << 20
RANGE_BYTES = 8 << 20
READ_BYTES, PIECE = 1 << 20, 1 << 16
LEAST_SHARED = 0
MAGIC = b"\x1f\x8b\x08"
VERSION = b"WARC/1.1\r\n"
DATE = "1970-01-01T00:00:00Z"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id, url: str | None, payload: bytes, refers_to, revisit: bool) -> bytes:
    """A gzip member. A revisit keeps the payload's digest and length, not its bytes."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    kind = "revisit" if revisit else "response"
    uri = "".join(c if c.isprintable() and not c.isspace() else "%{:02X}".format(ord(c)) for c in url or "")
    name = uuid.uuid5(uuid.NAMESPACE_URL, f"{page_id} {kind} {uri} {base32_sha1(payload)}")
    fields = [
        ("WARC-Type", kind),
        ("WARC-Record-ID", f"<urn:uuid:{name}>"),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", uri),
        ("WARC-Payload-Digest", f"sha1:{base32_sha1(payload)}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("X-Page-Id", "" if page_id is None else str(page_id)),
        ("X-Payload-Length", str(len(payload))),
    ]
    if revisit:
        fields += [("WARC-Profile", _PROFILE), ("X-Refers-To-Page-Id", str(refers_to))]
    fields.append(("Content-Length", str(len(block))))
    head = VERSION + "".join(f"{k}: {v}\r\n" for k, v in fields).encode("utf-8", "surrogatepass") + b"\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(head + block + b"\r\n\r\n") + packer.flush()


def revisits(pages: DataFrame, least: int = LEAST_SHARED) -> DataFrame:
    """(page_id, digest, refers_to) of pages whose payload of at least `least` bytes a smaller id has too."""
    own = pages.select("page_id", F.sha1("payload").alias("digest"), F.length("payload").alias("size")).where(F.col("size") >= least)
    first = own.groupBy("digest", "size").agg(F.min("page_id").alias("refers_to"), F.count("*").alias("n")).where("n > 1")
    # written, so that a payload of very many pages is either broadcast to them or split by AQE
    first = small_or_shuffled(written(first.drop("n"), "payloads"))
    found = own.join(first, ["digest", "size"]).where("refers_to is not null and (page_id is null or page_id > refers_to)")
    return found.select("page_id", "digest", "refers_to").distinct()


def write_warc(pages: DataFrame, folder: str, least: int = LEAST_SHARED, file_bytes: int = FILE_BYTES) -> int:
    """Writes pages(page_id, url, html) as records under `folder` and returns their number.

    A null html is an empty payload. Rows that repeat an id and payload that
    nothing smaller has are all responses; rows without an id revisit any with
    one. Other columns are not read.
    """
    own = pages.select("page_id", "url", F.coalesce(F.col("html").cast("binary"), F.lit(b"")).alias("payload"))
    told = revisits(own, least)
    told = told.select(F.col("page_id").alias("told_id"), F.col("digest").alias("told_digest"), "refers_to")
    same = F.col("page_id").eqNullSafe(F.col("told_id")) & (F.sha1("payload") == F.col("told_digest"))
    joined = own.join(told, same, "left").select("page_id", "url", "payload", "refers_to")

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        part, n, held, size = TaskContext.get().partitionId(), 0, [], 0

        def close() -> pd.DataFrame:
            nonlocal n, size
            write_file(f"{folder}/{part:06d}-{n:06d}.warc.gz", held)
            out = pd.DataFrame({"records": [len(held)]})
            held.clear()
            n, size = n + 1, 0
            return out

        for batch in batches:
            for page_id, url, payload, refers in zip(batch["page_id"].astype(object), batch["url"], batch["payload"], batch["refers_to"].astype(object)):
                page_id = None if pd.isna(page_id) else int(page_id)
                revisit = not pd.isna(refers)
                held.append(record(page_id, url, payload, int(refers) if revisit else None, revisit))
                size += len(held[-1])
                if size >= file_bytes:
                    yield close()
        if held:
            yield close()

    return joined.mapInPandas(write, "records long").agg(F.sum("records")).first()[0] or 0


class _Source:
    """Bytes of a file from a place on, read in pieces; only the last few are kept."""

    def __init__(self, file, size: int):
        self.file, self.size, self.start, self.data = file, size, 0, b""

    def at(self, place: int, least: int) -> bytes:
        """At least `least` bytes from `place` on, fewer only at the file's end."""
        if not self.start <= place <= self.start + len(self.data):
            self.start, self.data = place, b""
        end = min(place + least, self.size)
        while self.start + len(self.data) < end:
            self.file.seek(self.start + len(self.data))
            self.data += self.file.read(max(READ_BYTES, end - self.start - len(self.data)))
        if place - self.start > 4 * READ_BYTES:
            self.data, self.start = self.data[place - self.start :], place
        return self.data[place - self.start :]

    def piece(self, place: int) -> bytes:
        """At most PIECE bytes from `place` on, none at the file's end: what a small member needs is not copied by the megabyte."""
        if not self.start <= place < self.start + len(self.data):
            self.at(place, PIECE)
        at = place - self.start
        return self.data[at : at + PIECE]


def _headers(head: bytes) -> dict[str, str] | None:
    """A record's headers, if the bytes begin with its version line and hold them whole."""
    top, found, _ = head.partition(b"\r\n\r\n")
    lines = top.split(b"\r\n")
    if not found or lines[0] != VERSION.strip():
        return None
    out = {}
    for line in lines[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            return None
        out[name.decode("latin-1").lower()] = value.strip().decode("utf-8", "replace")
    return out if "warc-type" in out and "content-length" in out else None


def is_member(source: _Source, place: int) -> bool:
    """Whether the bytes from `place` on inflate to a record's version line and headers, however long these are."""
    unpack, head = zlib.decompressobj(31), bytearray()
    data = b""
    while True:
        if not data:
            data = source.piece(place)
            place += len(data)
        try:
            new = unpack.decompress(data, 1 << 16)
        except zlib.error:
            return False
        ended = unpack.eof or not (data or new)
        data = unpack.unconsumed_tail
        searched = max(0, len(head) - 3)
        head += new
        if not head.startswith(VERSION[: len(head)]):
            return False
        if head.find(b"\r\n\r\n", searched) >= 0:
            return _headers(bytes(head)) is not None
        if ended:
            return False


def inflate(source: _Source, place: int) -> tuple[bytes, int]:
    """A member's content and the place behind it."""
    unpack, parts = zlib.decompressobj(31), []
    while not unpack.eof:
        data = source.piece(place)
        if not data:
            raise ValueError("an archive ends within a record")
        parts.append(unpack.decompress(data))
        place += len(data) - len(unpack.unused_data)
    return b"".join(parts), place


def records_in(source: _Source, start: int, end: int) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and blocks of the records that start in [start, end)."""
    place = start
    while place < end:
        data = source.at(place, READ_BYTES)
        i = data.find(MAGIC)
        if i < 0:
            if len(data) <= len(MAGIC):
                return
            place += len(data) - len(MAGIC) + 1
            continue
        place += i
        if place >= end:
            return
        if not is_member(source, place):
            place += 1
            continue
        while place < end and place < source.size:  # from here on members follow each other
            content, place = inflate(source, place)
            headers = _headers(content)
            if headers is None:
                raise ValueError("a member is not a record")
            block = content[content.index(b"\r\n\r\n") + 4 :]
            yield headers, block[: int(headers["content-length"])]
        return


def read_warc(spark: SparkSession, folder: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """A row per record: page_id, payload_bytes, payload_digest, record_type, refers_to.

    Payloads of responses are hashed again; one that differs from its header fails the job.
    """
    from pyarrow import fs

    system, path = opened(folder)
    files = [f for f in system.get_file_info(fs.FileSelector(path, allow_not_found=True)) if f.base_name.endswith(".warc.gz") and f.base_name[0] != "."]
    ranges = [(f.base_name, f.size, s, min(s + range_bytes, f.size)) for f in files for s in range(0, f.size, range_bytes)]
    split = spark.createDataFrame(ranges, "name string, size long, start long, end long")
    split = split.repartition(max(1, min(len(ranges), 4096)), "name", "start")

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, size, start, end in batch.itertuples(index=False):
                rows = []
                system, path = opened(f"{folder}/{name}")
                with system.open_input_file(path) as file:
                    for headers, block in records_in(_Source(file, size), start, end):
                        digest = headers["warc-payload-digest"].removeprefix("sha1:")
                        length = int(headers["x-payload-length"])
                        if headers["warc-type"] == "response":
                            payload = block.partition(b"\r\n\r\n")[2]
                            if base32_sha1(payload) != digest or len(payload) != length:
                                raise ValueError("a payload differs from its digest")
                        page, refers = headers["x-page-id"], headers.get("x-refers-to-page-id")
                        rows.append((int(page) if page else None, length, digest, headers["warc-type"], int(refers) if refers else None))
                out = pd.DataFrame(rows, columns=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])
                out["page_id"], out["refers_to"] = out["page_id"].astype("Int64"), out["refers_to"].astype("Int64")
                yield out

    return split.mapInPandas(read, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")
