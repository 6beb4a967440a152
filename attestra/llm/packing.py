"""Packing by power-of-two decomposition: no sequence crosses documents and nothing is padded.

Each document (its ids and an end id) is cut into full sequences of ``longest`` tokens and then into one
piece for each set bit of the rest, longest first.  A piece is a sequence of its own; pieces of equal
length form a bucket, in which sequences are numbered without gaps.  Batches are drawn from one bucket,
so attention never sees two documents and no token is padding.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from attestra.llm.common import own_columns, prepared, small_side, written
from attestra.llm.encoding import KEPT, encoder

PIECES = "doc_id long, start long, length long, doc_tokens long, ids binary, task int, place long"


def binary_lengths(tokens: int, longest: int) -> list[int]:
    """Full lengths, then the powers of two that make up the rest, descending."""
    full, rest = divmod(tokens, longest)
    return [longest] * full + [1 << b for b in range(longest.bit_length() - 2, -1, -1) if rest >> b & 1]


def _cut(batches: Iterator[pa.RecordBatch], path: str, end_id: int, longest: int, kept: int) -> Iterator[pa.RecordBatch]:
    encode, task, places = encoder(path, kept), TaskContext.get().partitionId(), Counter()
    end = end_id.to_bytes(4, "little")
    schema = pa.schema(
        [("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("doc_tokens", pa.int64())]
        + [("ids", pa.binary()), ("task", pa.int32()), ("place", pa.int64())]
    )
    for batch in batches:
        texts = batch.column("text").to_pylist()
        rows: list[tuple] = []
        for doc_id, ids in zip(batch.column("doc_id").to_pylist(), encode.encode_batch(texts), strict=True):
            ids += end
            total, start = len(ids) // 4, 0
            for length in binary_lengths(total, longest):
                rows.append((doc_id, start, length, total, ids[4 * start : 4 * (start + length)], task, places[length]))
                places[length] += 1
                start += length
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True) if rows else [[]] * 7, schema, strict=True)], schema=schema
        )


def pack(docs: DataFrame, path: str, end_id: int = 0, longest: int = 1024, kept: int = KEPT) -> DataFrame:
    """Sequences of documents: ``sequence_id, length, offset, doc_id, start, doc_tokens, ids``.

    ``docs`` has ``doc_id`` and ``text``; ``longest`` is a power of two; ``kept`` bounds the words that a worker keeps.  A null text is empty and
    gives the end id alone; repeated rows are documents of their own; a null ``doc_id`` stays null; an
    empty table gives no rows.  ``ids`` holds little-endian unsigned 32-bit integers.  Longer buckets
    have the lower sequence ids.

    The texts are read once and never shuffled: tasks number their pieces for each length, and the
    counts of the tasks, one row for each task and length, give the numbers their offsets.
    """
    if longest < 1 or longest & (longest - 1):
        raise ValueError("longest must be a power of two")
    prepared(docs.sparkSession)
    cut = partial(_cut, path=path, end_id=end_id, longest=longest, kept=kept)
    pieces = written(own_columns(docs, "doc_id", "text").mapInArrow(cut, PIECES).sortWithinPartitions("length"), "pieces")
    counts = pieces.groupBy("length", "task").agg((F.max("place") + 1).alias("n"))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    within = counts.withColumn("in_bucket", F.coalesce(F.sum("n").over(before), F.lit(0)))
    buckets = counts.groupBy("length").agg(F.sum("n").alias("n"))
    longer = Window.orderBy(F.desc("length")).rowsBetween(Window.unboundedPreceding, -1)  # one row a length
    bases = buckets.select("length", F.coalesce(F.sum("n").over(longer), F.lit(0)).alias("base"))
    first = within.join(F.broadcast(bases), "length").select("length", "task", (F.col("base") + F.col("in_bucket")).alias("first"))
    first = small_side(written(first, "offsets"), row_bytes=24)
    return pieces.join(first, ["length", "task"]).select(
        (F.col("first") + F.col("place")).alias("sequence_id"),
        "length",
        F.lit(0).cast("long").alias("offset"),
        "doc_id",
        "start",
        "doc_tokens",
        "ids",
    )
