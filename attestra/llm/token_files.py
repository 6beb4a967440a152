"""Tokenised documents in ascending order in token files (see ``frames``), and what the files hold."""

from __future__ import annotations

import io
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import partial

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from attestra.llm.common import own_columns, prepared, written
from attestra.llm.encoding import encoder
from attestra.llm.frames import Reader, Writer

FILES = "path string, task int, n_documents long, n_tokens long, n_frames long, n_bytes long"
CONTENTS = "doc_id long, start long, n_tokens long, ids binary"


def _store(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (fs.LocalFileSystem(), folder)


@contextmanager
def opened(path: str) -> Iterator[io.IOBase]:
    """Random access to a file of any store that Arrow knows."""
    store, place = _store(path)
    with store.open_input_file(place) as file:
        yield file


def _write(batches: Iterator[pa.RecordBatch], folder: str, path: str, end_id: int) -> Iterator[pa.RecordBatch]:
    """One file for a task.  Each attempt writes under a name of its own and renames it when it is whole;
    equal attempts write equal bytes, so whichever is last leaves the same file."""
    encode, task = encoder(path), TaskContext.get().partitionId()
    end = end_id.to_bytes(4, "little")
    store, place = _store(folder)
    store.create_dir(place, recursive=True)
    name = f"tokens-{task:06d}.zst"
    attempt = f"{place}/.{name}.{uuid.uuid4().hex}"
    writer = None
    with store.open_output_stream(attempt) as file:
        writer = Writer(file)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), encode.encode_batch(texts), strict=True):
                writer.add(doc_id, ids + end)
        writer.close()
    if not writer.counts:
        store.delete_file(attempt)
        return
    store.move(attempt, f"{place}/{name}")
    row = (f"{folder}/{name}", task, len(writer.counts), sum(writer.counts), len(writer.entries), writer.bytes)
    types = [pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
    names = [c.split()[0] for c in FILES.split(", ")]
    yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types, strict=True)], names=names)


def write_token_files(docs: DataFrame, folder: str, path: str, end_id: int = 1) -> DataFrame:
    """Write the ids of all documents to ``folder`` in ascending ``doc_id`` order; return one row a file.

    Null ids come first, a null text is empty (the end id alone), repeated ids are ordered by a hash of
    their text, an empty table writes no file.  Texts are range-partitioned once, on (``doc_id``, hash),
    so repeated ids are split too; tasks stream their rows to one file each.  ``first`` is the number of
    ids in all files before.
    """
    spark = prepared(docs.sparkSession)
    tie = F.xxhash64(F.coalesce("text", F.lit("")))
    rows = own_columns(docs, "doc_id", "text").withColumn("_tie", tie)
    rows = rows.repartitionByRange(F.col("doc_id").asc_nulls_first(), "_tie")
    rows = rows.sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "_tie").select("doc_id", "text")
    files = rows.mapInArrow(partial(_write, folder=folder, path=path, end_id=end_id), FILES)
    files = written(files, "files")
    # One row a file: its size is the number of files, not of documents.
    before = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    return files.withColumn("first", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema
        )

    for files in batches:
        for path, first in zip(files.column("path").to_pylist(), files.column("first").to_pylist(), strict=True):
            with opened(path) as file:
                rows, size = [], 0
                for doc_id, start, ids in Reader(file):
                    rows.append((doc_id, first + start, len(ids) // 4, ids))
                    size += len(ids)
                    if size > 4 << 20 or len(rows) >= 2000:
                        yield batch(rows)
                        rows, size = [], 0
                if rows:
                    yield batch(rows)


def read_token_files(files: DataFrame) -> DataFrame:
    """All documents of the files: ``doc_id, start, n_tokens, ids``; each file is read by one task."""
    count = max(1, files.count())
    return files.select("path", "first").repartition(count).mapInArrow(_read, CONTENTS)


def read_documents(path: str, doc_ids: set[int]) -> dict[int, list[bytes]]:
    """The ids of some documents of one file; only their frames are decompressed."""
    found: dict[int, list[bytes]] = {}
    with opened(path) as file:
        reader = Reader(file)
        for position, doc_id in enumerate(reader.doc_ids):
            if doc_id in doc_ids:
                found.setdefault(doc_id, []).append(reader.ids(position))
    return found
