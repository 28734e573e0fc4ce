import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from signalbarn.llm import rans
from signalbarn.llm.packing import first_fit_decreasing, pack_documents, piece_digests
from signalbarn.llm.rans import TokenFile, encode_file
from signalbarn.llm.tokenfiles import read_token_files, write_token_files
from signalbarn.llm.tokens import TextEncoder

BYTES, WORDS = (public_tokenizers.path(f"{n}.json") for n in ("byte_bpe_50k", "word_bpe_49k"))
ODD = ["", "a", " a", "a ", "  a  b", "a\n\nb\t c", "don't I'M we'll", '"x"_y__z 12a34', "café ß İx", "a\xa0b", "中文 x", "<|endoftext|>hi", "hi <|endoftext|> there", "<|startoftext|>a b<|endoftext|>", "<|ENDOFTEXT|> a", "<|endoftext", "x\x1cy", "½ ² Ⅷ", "a\tb\r\nc d", "e\u0301", "ÀÉ Ǆ", "'s's 'tis", "a \n b", " \n", "\n", "a.b,c ,d . e.. f, _. x", "...", "a.", "(a), b"]


def plain(path):
    t = Tokenizer.from_file(path)
    return lambda x: t.encode(x or "", add_special_tokens=False).ids


def texts(n, seed=0):
    rng = random.Random(seed)
    bits = ["the", "Thing", "don't", "ßé", "12", ",", ".", "\n", " ", "  ", "_", "…", "İ", "#", "tion", "'s", "\t"]
    return ["".join(rng.choice(bits) + rng.choice(["", " "]) for _ in range(rng.randrange(60))) for _ in range(n)]


@pytest.mark.parametrize("path", [BYTES, WORDS])
def test_encoder(path):
    own, other = TextEncoder(path), plain(path)
    assert own.kind != "other"
    for text in ODD + texts(400):
        assert np.frombuffer(own.encode(text), "<u4").tolist() == other(text), text


def test_encoder_of_many_and_its_cache():
    for path in (BYTES, WORDS):
        other, many = plain(path), [None, *ODD, *texts(200, 2), "", *texts(50, 2)]
        assert [np.frombuffer(x, "<u4").tolist() for x in TextEncoder(path, 50).encode_many(many)] == [other(t) for t in many]


def test_file_round_trip(monkeypatch):
    monkeypatch.setattr(rans, "LANES", 16)
    monkeypatch.setattr(rans, "BLOCK", 1024)
    monkeypatch.setattr(rans, "CHECKPOINT", 8)
    rng = np.random.default_rng(1)
    docs = [rng.zipf(1.4, n) % 50000 for n in (0, 1, 15, 16, 17, 1024, 3000, 0, 5, 1023)] + [np.full(2000, 7), np.array([2**32 - 1])]
    data = encode_file([None, *range(11)], docs)
    reads = []
    file = TokenFile.open(lambda s, n: reads.append(n) or data[s : s + n])
    got = list(file.documents())
    assert [i for i, _ in got] == [None, *range(11)] and all((g == d).all() and len(g) == len(d) for (_, g), d in zip(got, docs))
    ends, blocks = np.cumsum([len(d) for d in docs]), len(file.header["blocks"])
    for step in (1, 2, 3, blocks):
        by_range = [d for i in range(0, blocks, step) for d in file.documents_of(i, min(i + step, blocks) - 1)]
        assert [(i, at) for i, at, _ in by_range] == [(i, e - len(d)) for i, e, d in zip([None, *range(11)], ends, docs)]
        assert all(len(ids) == len(d) and (ids == d).all() for (_, _, ids), d in zip(by_range, docs))
    whole = np.concatenate(docs)
    for start, n in [(0, 1), (5, 2000), (1023, 2), (1500, 700), (len(whole) - 3, 3), (7, 0)]:
        reads.clear()
        assert (file.ids(start, n) == whole[start : start + n]).all()
    damaged = bytearray(data)
    damaged[-9] ^= 1
    bad = TokenFile.open(lambda s, n: bytes(damaged[s : s + n]))
    with pytest.raises(ValueError):
        list(bad.documents())
    assert list(TokenFile.open(lambda s, n: encode_file([], [])[s : s + n]).documents()) == []


def documents(spark):
    rows = [(900 - 7 * i, t, i) for i, t in enumerate(texts(120, 3))]
    rows += [(5000, None, 0), (5001, "", 0), (4, "twice", 1), (4, "twice", 1), (4, "other", 1), (None, "no id", 1), (6000, "Long text. " * 4000, 1)]
    return rows, spark.createDataFrame(rows, "doc_id long, text string, ids int")


def test_token_files(spark, out):
    rows, docs = documents(spark)
    write_token_files(docs, f"{out}/tokens", BYTES, file_ids=500, partitions=3)
    got = sorted((tuple(r) for r in read_token_files(spark, f"{out}/tokens").collect()), key=lambda r: r[1])
    encode, at, want = plain(BYTES), 0, []
    for doc_id, text, _ in sorted(rows, key=lambda r: (r[0] is not None, r[0], r[1] or "")):
        ids = [*encode(text), 0]
        want.append((doc_id, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert got == want
    write_token_files(docs.limit(0), f"{out}/none", BYTES)
    assert read_token_files(spark, f"{out}/none").count() == 0


def test_first_fit_decreasing():
    rng = random.Random(4)
    for n in (0, 1, 5, 300):
        lengths = [rng.randrange(1, 101) for _ in range(n)]
        placed = first_fit_decreasing(lengths, 100)
        bins: list[int] = []
        want = {}
        for i in sorted(range(n), key=lambda i: (-lengths[i], i)):
            b = next((b for b, used in enumerate(bins) if used + lengths[i] <= 100), len(bins))
            if b == len(bins):
                bins.append(0)
            want[i] = (b, bins[b])
            bins[b] += lengths[i]
        assert placed == [want[i] for i in range(n)]


def test_packing(spark):
    rows, docs = documents(spark)
    packed = pack_documents(docs, WORDS, length=256, group_docs=40)
    encode = plain(WORDS)
    want = sorted(((d, [*encode(t), 2]) for d, t, _ in rows), key=str)
    pieces, bins = {}, {}
    for r in packed.collect():
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert len(ids) == r.length
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
        pieces.setdefault((str(r.doc_id), r.doc_tokens), []).append((r.start, ids))
    for places in bins.values():
        at = 0
        for offset, n in sorted(places):
            assert offset == at
            at += n
        assert at <= 256
    tokens = sum(len(i) for _, i in want)
    assert sum(len(i) for p in pieces.values() for _, i in p) == tokens
    for d, ids in want:
        parts = sorted(pieces[(str(d), len(ids))])
        got = [x for _, p in parts for x in p]
        copies = sum(1 for e, i in want if (e, len(i)) == (d, len(ids)))
        assert len(got) == copies * len(ids)
        if copies == 1:
            assert got == ids
    assert len(bins) * 256 < 1.1 * tokens
    digests = piece_digests(packed)
    assert "ids" not in digests.columns
    crc = {(str(r.doc_id), r.start, r.length, r.sequence_id): r.ids_crc32 for r in digests.collect()}
    for r in packed.collect():
        assert crc[str(r.doc_id), r.start, r.length, r.sequence_id] == zlib.crc32(r.ids)
    assert pack_documents(docs.limit(0), WORDS).count() == 0


def test_repeated_rows_are_dealt_over_groups(spark):
    docs = spark.createDataFrame([(7, "the same text", 0)] * 900 + [(i, f"text {i}", 1) for i in range(100)], "doc_id long, text string, n int")
    packed = pack_documents(docs.repartition(3), WORDS, length=64, group_docs=50).collect()
    encode = plain(WORDS)
    copies = [r for r in packed if r.doc_id == 7 and r.doc_tokens == len(encode("the same text")) + 1]
    groups = {r.sequence_id >> 32 for r in copies}
    assert len(groups) == 20 and max(sum(1 for r in copies if r.sequence_id >> 32 == g) for g in groups) < 100
    assert sum(r.length for r in packed) == sum(len(encode(t)) + 1 for t in ["the same text"] * 900 + [f"text {i}" for i in range(100)])
    whole = [*encode("the same text"), 2]
    assert sum(r.length for r in copies) == 900 * len(whole)
    starts = [r for r in copies if r.length == len(whole)]
    assert all(np.frombuffer(r.ids, "<u4").tolist() == whole for r in starts) and len(starts) > 800


def test_one_id_with_many_texts_is_split(spark, out):
    docs = spark.createDataFrame([(5, t) for t in texts(400, 9)], "doc_id long, text string")
    write_token_files(docs, f"{out}/tokens", BYTES, partitions=4, busy_id=100)
    import os

    assert len({f[:6] for f in os.listdir(f"{out}/tokens") if f.endswith(".tok")}) == 4
    rows = read_token_files(spark, f"{out}/tokens").orderBy("start").collect()
    want = [len(plain(BYTES)(t)) + 1 for t in sorted(texts(400, 9))]
    assert [r.n_tokens for r in rows] == want
