"""Token files: independent zstandard frames, a document directory and a trailing seek table.

The layout is the public seekable format: frames, then a skippable frame with one entry for each frame
(compressed size, decompressed size, checksum) and a nine-byte footer.  Before it stands one more
skippable frame with the directory of documents, so any zstandard tool still reads the ids alone.  The
decompressed stream is one sequence of little-endian unsigned 32-bit ids; a small document lies in one
frame, a document longer than a frame has frames of its own.

    frames ...                                            zstandard, each on its own
    skippable 0x184D2A50: directory                       zstandard frame of columns, see ``_directory``
    skippable 0x184D2A5E: entries, count, 0x80, magic     seek table with checksums
"""

from __future__ import annotations

import bisect
import struct
from collections.abc import Iterator
from itertools import accumulate
from typing import BinaryIO

import numpy as np
import xxhash
import zstandard

# Fixed values of the public format.
SKIPPABLE_DIRECTORY = 0x184D2A50
SKIPPABLE_SEEK_TABLE = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
CHECKSUM_FLAG = 0x80

FRAME_BYTES = 1 << 18
LEVEL = 3


def _checksum(data: bytes | memoryview) -> int:
    """The low 32 bits of XXH64 with seed 0, as the format asks."""
    return xxhash.xxh64_intdigest(data, 0) & 0xFFFFFFFF


class Writer:
    """Appends documents to a file; holds one frame and the directory in memory."""

    def __init__(self, file: BinaryIO, frame_bytes: int = FRAME_BYTES):
        self.file, self.frame_bytes = file, frame_bytes
        self.compress = zstandard.ZstdCompressor(level=LEVEL).compress
        self.buffer = bytearray()
        self.entries: list[tuple[int, int, int]] = []
        self.doc_ids: list[int | None] = []
        self.counts: list[int] = []
        self.bytes = 0

    def _write(self, data: bytes) -> None:
        self.file.write(data)
        self.bytes += len(data)

    def _flush(self) -> None:
        for at in range(0, len(self.buffer), self.frame_bytes):
            part = bytes(self.buffer[at : at + self.frame_bytes])
            packed = self.compress(part)
            self.entries.append((len(packed), len(part), _checksum(part)))
            self._write(packed)
        self.buffer.clear()

    def add(self, doc_id: int | None, ids: bytes) -> None:
        if self.buffer and len(self.buffer) + len(ids) > self.frame_bytes:
            self._flush()
        self.buffer += ids
        self.doc_ids.append(doc_id)
        self.counts.append(len(ids) // 4)
        if len(self.buffer) >= self.frame_bytes:
            self._flush()

    def _directory(self) -> bytes:
        """Number of documents, their ids, which of them are not null, their numbers of tokens."""
        given = np.array([d is not None for d in self.doc_ids], dtype="u1")
        doc_ids = np.array([d or 0 for d in self.doc_ids], dtype="<i8")
        columns = doc_ids.tobytes() + given.tobytes() + np.array(self.counts, dtype="<u8").tobytes()
        return self.compress(struct.pack("<Q", len(self.doc_ids)) + columns)

    def close(self) -> None:
        self._flush()
        directory = self._directory()
        self._write(struct.pack("<II", SKIPPABLE_DIRECTORY, len(directory)) + directory)
        table = b"".join(struct.pack("<III", *e) for e in self.entries)
        footer = struct.pack("<IBI", len(self.entries), CHECKSUM_FLAG, SEEKABLE_MAGIC)
        self._write(struct.pack("<II", SKIPPABLE_SEEK_TABLE, len(table) + len(footer)) + table + footer)


class Reader:
    """Reads documents of a file; decompresses the frames that hold them and no others."""

    def __init__(self, file: BinaryIO):
        self.file = file
        size = file.seek(0, 2)
        count, flags, magic = struct.unpack("<IBI", self._at(size - 9, 9))
        if magic != SEEKABLE_MAGIC or flags != CHECKSUM_FLAG:
            raise ValueError("no seek table with checksums at the end of the file")
        table = self._at(size - 9 - 12 * count, 12 * count)
        self.entries = list(struct.iter_unpack("<III", table))
        self.places = [0, *accumulate(e[0] for e in self.entries)]
        self.starts = [0, *accumulate(e[1] for e in self.entries)]
        head = self.places[-1]
        magic, length = struct.unpack("<II", self._at(head, 8))
        if magic != SKIPPABLE_DIRECTORY:
            raise ValueError("no directory of documents after the frames")
        raw = zstandard.ZstdDecompressor().decompress(self._at(head + 8, length))
        n = struct.unpack_from("<Q", raw)[0]
        ids, given = np.frombuffer(raw, "<i8", n, 8), np.frombuffer(raw, "u1", n, 8 + 8 * n)
        self.doc_ids = [int(d) if g else None for d, g in zip(ids, given, strict=True)]
        self.counts = np.frombuffer(raw, "<u8", n, 8 + 9 * n).astype("i8")
        self.before = np.concatenate([[0], np.cumsum(self.counts)])
        self.decompressed = 0
        self._frame: tuple[int, bytes] = (-1, b"")

    def _at(self, place: int, length: int) -> bytes:
        self.file.seek(place)
        data = self.file.read(length)
        if len(data) != length:
            raise ValueError("the file is cut off")
        return data

    def frame(self, k: int) -> bytes:
        if self._frame[0] != k:
            packed, length, checksum = self.entries[k]
            data = zstandard.ZstdDecompressor().decompress(self._at(self.places[k], packed), max_output_size=length)
            if len(data) != length or _checksum(data) != checksum:
                raise ValueError(f"frame {k} does not match its checksum")
            self._frame = (k, data)
            self.decompressed += 1
        return self._frame[1]

    def ids(self, position: int) -> bytes:
        """The ids of the document at ``position`` in the file."""
        start, end = 4 * int(self.before[position]), 4 * int(self.before[position + 1])
        parts, k = [], bisect.bisect_right(self.starts, start) - 1
        while start < end:
            data, first = self.frame(k), self.starts[k]
            part = data[start - first : end - first]
            parts.append(part)
            start += len(part)
            k += 1
        return b"".join(parts)

    def __iter__(self) -> Iterator[tuple[int | None, int, bytes]]:
        """Document id, ids before it in the file, its ids."""
        for position, doc_id in enumerate(self.doc_ids):
            yield doc_id, int(self.before[position]), self.ids(position)
