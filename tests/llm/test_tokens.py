"""Token files, counts and packing against the library's ids of whole texts."""

import io
import zlib

import numpy as np
import public_tokenizers
import pytest
import zstandard

from attestra.llm.encoding import encoder
from attestra.llm.frames import Reader, Writer
from attestra.llm.packing import binary_lengths, pack
from attestra.llm.token_counts import count_tokens
from attestra.llm.token_files import read_documents, read_token_files, write_token_files

BYTES, WORDS = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json"))
BLOB = "x" * 120_000


def ids(path, text):
    if text == BLOB and path == BYTES:  # the library takes long for one huge word; both sides use it whole
        return encoder(path).encode_batch([text])[0]
    return np.array(encoder(path).tokenizer.encode(text or "", add_special_tokens=False).ids, dtype="<u4").tobytes()


def number(value):
    return value.to_bytes(4, "little")


@pytest.mark.parametrize("name", ["awkward", "sample"])
def test_files_hold_all_documents_in_order(name, request, tmp_path):
    docs = request.getfixturevalue(name)
    files = write_token_files(docs, str(tmp_path), WORDS, end_id=1)
    got = [tuple(r) for r in read_token_files(files).collect()]
    want = sorted((r.doc_id is not None, r.doc_id or 0, ids(WORDS, r.text) + number(1)) for r in docs.select("doc_id", "text").collect())
    assert sorted((d is not None, d or 0, i) for d, _, _, i in got) == want
    in_order = sorted(got, key=lambda r: r[1])
    assert [r[1] for r in in_order] == list(np.cumsum([0] + [r[2] for r in in_order[:-1]]))
    assert [(r[0] is not None, r[0] or 0) for r in in_order] == [w[:2] for w in want]
    assert all(4 * n == len(i) for _, _, n, i in got)
    row = files.collect()[0]
    chosen = {d for d, *_ in got if d is not None and d % 3 == 0}
    some = read_documents(row.path, chosen)
    assert some and all(sorted(v) == sorted(i for d, _, _, i in got if d == k) for k, v in some.items() if k > 5)


def test_no_documents_no_files(nothing, tmp_path):
    files = write_token_files(nothing, str(tmp_path), WORDS)
    assert files.count() == 0 and read_token_files(files).count() == 0


def made(sizes, frame_bytes=400):
    out = io.BytesIO()
    writer = Writer(out, frame_bytes)
    docs = [(None if k == 2 else k - 3, np.arange(n, dtype="<u4").tobytes()) for k, n in enumerate(sizes)]
    for doc in docs:
        writer.add(*doc)
    writer.close()
    return out.getvalue(), docs


def test_only_the_frames_asked_for_are_decompressed():
    data, docs = made([10, 20, 0, 500, 3, 90, 90, 90])
    reader = Reader(io.BytesIO(data))
    assert len(reader.entries) > 5
    assert reader.ids(7) == docs[7][1] and reader.decompressed == 1
    assert reader.ids(3) == docs[3][1] and reader.decompressed == 6  # a document of five frames
    assert [(d, i) for d, _, i in Reader(io.BytesIO(data))] == docs
    # Any zstandard reader sees the ids alone.
    assert zstandard.ZstdDecompressor().stream_reader(io.BytesIO(data), read_across_frames=True).read() == b"".join(i for _, i in docs)


def test_damage_is_found_by_the_frame_that_has_it():
    data, docs = made([50, 90, 90, 90])
    reader = Reader(io.BytesIO(data))
    broken = bytearray(data)
    broken[reader.places[1] + reader.entries[1][0] - 1] ^= 255
    other = Reader(io.BytesIO(bytes(broken)))
    assert other.ids(0) == docs[0][1]
    with pytest.raises((ValueError, zstandard.ZstdError)):
        for k in range(len(docs)):
            other.ids(k)
    with pytest.raises(ValueError):
        Reader(io.BytesIO(data[:-3]))


@pytest.mark.parametrize("name", ["awkward", "sample"])
def test_packing(name, request):
    docs = request.getfixturevalue(name)
    rows = pack(docs, BYTES).collect()
    want = []
    for r in docs.select("doc_id", "text").collect():
        whole = ids(BYTES, r.text) + number(0)
        start = 0
        for n in binary_lengths(len(whole) // 4, 1024):
            want.append((r.doc_id, start, n, len(whole) // 4, whole[4 * start : 4 * (start + n)]))
            start += n
        assert 4 * start == len(whole)
    key = lambda r: (r[0] is not None, r[0] or 0, *r[1:])
    assert sorted(map(key, ((r.doc_id, r.start, r.length, r.doc_tokens, bytes(r.ids)) for r in rows))) == sorted(map(key, want))
    assert sorted(r.sequence_id for r in rows) == list(range(len(rows))) and {r.offset for r in rows} == {0}
    by_id = sorted(rows, key=lambda r: r.sequence_id)
    assert [r.length for r in by_id] == sorted((r.length for r in rows), reverse=True)
    assert all(r.length & (r.length - 1) == 0 and r.length <= 1024 for r in rows)


def test_packing_of_nothing(nothing):
    assert pack(nothing, BYTES).count() == 0
    with pytest.raises(ValueError):
        pack(nothing, BYTES, longest=1000)


def test_binary_lengths():
    assert binary_lengths(2048 + 700, 1024) == [1024, 1024, 512, 128, 32, 16, 8, 4]
    assert binary_lengths(1, 1024) == [1]


@pytest.mark.parametrize("name,chunk,overlap", [("sample", 1 << 14, 1 << 8), ("sample", 200, 16), ("sample", 60, 4), ("awkward", 2000, 8)])
def test_counts(name, chunk, overlap, request):
    docs = request.getfixturevalue(name)
    got = sorted((r.doc_id is not None, r.doc_id or 0, r.n_bytes, r.n_tokens) for r in count_tokens(docs, BYTES, chunk, overlap).collect())
    want = sorted(
        (r.doc_id is not None, r.doc_id or 0, len((r.text or "").encode()), len(ids(BYTES, r.text)) // 4)
        for r in docs.select("doc_id", "text").collect()
    )
    assert got == want


def test_special_strings_and_odd_spaces_at_the_seams(spark):
    pieces = ["<|endoftext|>", " ", "\n", "\n\n", " \x1c ", " ", "it's", "x" * 40, "é", "a  b"]
    texts = ["".join(pieces[(k * j + j // 3) % len(pieces)] for j in range(90)) for k in range(1, 30)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.n_tokens for r in count_tokens(docs, BYTES, 50, 5).collect()}
    assert got == {k: len(ids(BYTES, t)) // 4 for k, t in enumerate(texts)}


def test_counts_of_nothing(nothing):
    assert count_tokens(nothing, BYTES).count() == 0


def test_crc_of_the_query_is_zlibs(sample):
    from pyspark.sql import functions as F

    rows = pack(sample, BYTES).select("ids", F.crc32("ids").alias("c")).limit(50).collect()
    assert all(zlib.crc32(bytes(r.ids)) == r.c for r in rows)
