"""Token-id files: static range asymmetric numeral systems in interleaved lanes.

A file holds whole documents in order. Its ids share one frequency table and are
cut into blocks that are coded independently of each other. In a block, id i
belongs to lane i mod LANES; all lanes advance together, as numpy vectors.
Encoding goes backwards so that decoding goes forwards. Each block notes the
lanes' states and its place in the stream at regular steps (checkpoints), so
that decoding can start there, and a crc32 of its ids.

    file   = magic, header length (4 bytes), header (JSON), block*
    header = documents' ids and lengths, table, and offset, size, count, crc32 and checkpoints of each block;
             a crc32 of the header follows it
"""

from __future__ import annotations

import base64
import json
import struct
import zlib
from dataclasses import dataclass

import numpy as np

MAGIC = b"TKRANS1\n"
LANES = 2048
#: Ids in a block, and steps (of LANES ids) between checkpoints.
BLOCK = 1 << 19
CHECKPOINT = 128
#: Frequencies add up to 2 ** BITS; the largest alphabet is a quarter of that.
BITS = 20
_LOW = np.uint64(1 << 31)
_TOTAL = 1 << BITS


def frequencies(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids that occur and their frequencies, at least 1 each, that add up to 2 ** BITS."""
    if len(ids) and ids.max() < _TOTAL:
        counts = np.bincount(ids)
        symbols = np.flatnonzero(counts)
        counts = counts[symbols]
    else:
        symbols, counts = np.unique(ids, return_counts=True)
    if len(symbols) > _TOTAL // 4:
        raise ValueError(f"more than {_TOTAL // 4} different ids in one file")
    if not len(symbols):
        return symbols, counts
    free = _TOTAL - len(symbols)
    freq = 1 + (counts * (free / counts.sum())).astype(np.int64)
    freq[np.argmax(counts)] += _TOTAL - freq.sum()
    return symbols, freq


def _pack(numbers: np.ndarray, kind: str = "<u8") -> str:
    return base64.b64encode(zlib.compress(np.ascontiguousarray(numbers.astype(kind)).tobytes(), 1)).decode()


def _unpack(text: str, kind: str = "<u8") -> np.ndarray:
    return np.frombuffer(zlib.decompress(base64.b64decode(text)), kind)


def encode_block(slots: np.ndarray, freq: np.ndarray, cum: np.ndarray) -> tuple[bytes, list, np.ndarray]:
    """Words, checkpoints (word place, states by step) and the states to start decoding with.

    `slots` are positions in the table. The last step may use fewer lanes.
    """
    steps = -(-len(slots) // LANES)
    state = np.full(LANES, _LOW, np.uint64)
    out: list[np.ndarray] = []
    marks: list[tuple[int, int, np.ndarray]] = []
    written = 0
    for step in range(steps - 1, -1, -1):
        s = slots[step * LANES : (step + 1) * LANES]
        n = len(s)
        f, c = freq[s], cum[s]
        x = state[:n]
        full = x >= (f << np.uint64(63 - BITS))
        if full.any():
            # decoding takes words in lane order, so within a step they are stored so
            out.append((x[full] & np.uint64(0xFFFFFFFF)).astype("<u4"))
            written += int(full.sum())
            x = np.where(full, x >> np.uint64(32), x)
        times = x // f
        state[:n] = (times << np.uint64(BITS)) + c + (x - times * f)
        if step and step % CHECKPOINT == 0:
            marks.append((step, written, state.copy()))
    words = np.concatenate(out[::-1]) if out else np.empty(0, "<u4")
    checkpoints = [(step, len(words) - w, states) for step, w, states in marks[::-1]]
    return words.tobytes(), checkpoints, state


def decode_steps(words: np.ndarray, state: np.ndarray, count: int, lookup: np.ndarray, freq: np.ndarray, cum: np.ndarray) -> np.ndarray:
    """`count` table positions from the words and states of a block's start or of a checkpoint."""
    found = np.empty(count, np.int64)
    state = state.copy()
    at, mask = 0, np.uint64(_TOTAL - 1)
    for start in range(0, count, LANES):
        n = min(LANES, count - start)
        x = state[:n]
        low = x & mask
        s = lookup[low]
        found[start : start + n] = s
        x = freq[s] * (x >> np.uint64(BITS)) + low - cum[s]
        short = x < _LOW
        k = int(short.sum())
        if k:
            x[short] = (x[short] << np.uint64(32)) | words[at : at + k]
            at += k
        state[:n] = x
    return found


def encode_file(doc_ids: list, documents: list[np.ndarray]) -> bytes:
    """The bytes of a file that holds these documents, in this order."""
    lengths = np.array([len(d) for d in documents], np.int64)
    ids = np.concatenate([np.asarray(d, "<u4") for d in documents]) if documents else np.empty(0, "<u4")
    symbols, counts = frequencies(ids)
    freq = counts.astype(np.uint64)
    cum = np.concatenate([[0], np.cumsum(counts)])[:-1].astype(np.uint64) if len(counts) else freq
    if len(symbols) and symbols[-1] < _TOTAL:
        place = np.zeros(int(symbols[-1]) + 1, np.int32)
        place[symbols] = np.arange(len(symbols))
        slots = place[ids]
    else:
        slots = np.searchsorted(symbols, ids)
    blocks, body, offset = [], [], 0
    for start in range(0, len(ids), BLOCK):
        part = slots[start : start + BLOCK]
        words, checkpoints, state = encode_block(part, freq, cum)
        crc = zlib.crc32(ids[start : start + BLOCK])
        blocks.append(
            {
                "offset": offset,
                "size": len(words),
                "count": len(part),
                "crc32": crc,
                "state": _pack(state),
                "checkpoints": [[step, word, _pack(states)] for step, word, states in checkpoints],
            }
        )
        body.append(words)
        offset += len(words)
    header = json.dumps(
        {"doc_ids": doc_ids, "lengths": _pack(lengths), "symbols": _pack(np.diff(symbols.astype(np.int64), prepend=0)), "freq": _pack(counts), "blocks": blocks}
    ).encode()
    return b"".join([MAGIC, struct.pack("<I", len(header)), header, struct.pack("<I", zlib.crc32(header)), *body])


@dataclass
class TokenFile:
    """A file's header and a way to read ranges of bytes of it."""

    header: dict
    body: int
    read: object

    @classmethod
    def open(cls, read) -> "TokenFile":
        """`read(start, length)` gives the file's bytes."""
        start = read(0, len(MAGIC) + 4)
        if start[: len(MAGIC)] != MAGIC:
            raise ValueError("not a token file")
        (n,) = struct.unpack("<I", start[len(MAGIC) :])
        text = read(len(MAGIC) + 4, n + 4)
        if zlib.crc32(text[:n]) != struct.unpack("<I", text[n:])[0]:
            raise ValueError("a token file's header is damaged")
        return cls(json.loads(text[:n]), len(MAGIC) + 8 + n, read)

    def _table(self):
        if not hasattr(self, "table"):
            symbols = np.cumsum(_unpack(self.header["symbols"]).astype(np.int64))
            counts = _unpack(self.header["freq"]).astype(np.int64)
            cum = np.concatenate([[0], np.cumsum(counts)])[:-1]
            lookup = np.repeat(np.arange(len(counts), dtype=np.int32), counts)
            self.table = symbols, counts.astype(np.uint64), cum.astype(np.uint64), lookup
        return self.table

    def block(self, i: int) -> np.ndarray:
        """All ids of a block, checked against its crc32."""
        b = self.header["blocks"][i]
        symbols, freq, cum, lookup = self._table()
        words = np.frombuffer(self.read(self.body + b["offset"], b["size"]), "<u4").astype(np.uint64)
        ids = symbols[decode_steps(words, _unpack(b["state"]), b["count"], lookup, freq, cum)].astype("<u4")
        if zlib.crc32(ids.tobytes()) != b["crc32"]:
            raise ValueError(f"block {i} of a token file is damaged")
        return ids

    def ids(self, start: int, count: int) -> np.ndarray:
        """`count` ids from `start` on, decoded from the checkpoints before them."""
        symbols, freq, cum, lookup = self._table()
        parts, end = [], start + count
        for i, b in enumerate(self.header["blocks"]):
            first = i * BLOCK
            if first + b["count"] <= start or first >= end:
                continue
            skip = max(0, start - first)
            step, word, state = 0, 0, b["state"]
            for c in b["checkpoints"]:
                if c[0] * LANES <= skip:
                    step, word, state = c
            upto = min(b["count"], end - first)
            words = np.frombuffer(self.read(self.body + b["offset"] + 4 * word, b["size"] - 4 * word), "<u4").astype(np.uint64)
            slots = decode_steps(words, _unpack(state), upto - step * LANES, lookup, freq, cum)
            parts.append(symbols[slots[skip - step * LANES :]].astype("<u4"))
        return np.concatenate(parts) if parts else np.empty(0, "<u4")

    def documents_of(self, first: int, last: int):
        """(doc_id, place of its first id, ids) of the documents that start in the blocks from first to last, in order.

        The last of them may end in later blocks, of which only what it holds is decoded.
        """
        blocks = self.header["blocks"]
        lengths = _unpack(self.header["lengths"]).astype(np.int64)
        starts = np.cumsum(lengths) - lengths
        low, high = first * BLOCK, last * BLOCK + blocks[last]["count"]
        own = np.flatnonzero((starts >= low) & ((starts < high) | (last == len(blocks) - 1)))  # at the very end may stand empty ones
        held, at, block = np.empty(0, "<u4"), low, first  # the ids from `at` on: no more than two blocks and a document
        for d in own.tolist():
            start, end = int(starts[d]), int(starts[d] + lengths[d])
            while at + len(held) < end:
                if block <= last:
                    more, block = self.block(block), block + 1
                else:
                    more = self.ids(at + len(held), end - at - len(held))
                gone = min(start - at, len(held))
                held, at = np.concatenate([held[gone:], more]), at + gone
            yield self.header["doc_ids"][d], start, held[start - at : end - at]

    def documents(self):
        """(doc_id, ids) in order, block by block: no more than a block and one document is held."""
        blocks = iter(range(len(self.header["blocks"])))
        held: list[np.ndarray] = []
        have = 0
        for doc_id, n in zip(self.header["doc_ids"], _unpack(self.header["lengths"]).astype(np.int64).tolist()):
            while have < n:
                held.append(self.block(next(blocks)))
                have += len(held[-1])
            ids = np.concatenate([np.empty(0, "<u4"), *held]) if len(held) != 1 else held[0]
            yield doc_id, ids[:n]
            held, have = [ids[n:]], have - n
