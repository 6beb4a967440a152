"""Fixed-size tables of hashed keys: their size is a parameter and does not grow with the input.

They carry what every task must know of all keys (how frequent a word is, whether a key is wanted) to
all tasks.  Keys that share a slot only make the answer coarser; whoever uses a table must be right for
any answer and may only become slower.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROW = 4096  # slots of one collected row


def slots_of(hashes: np.ndarray, bits: int) -> np.ndarray:
    """The slot of each unsigned 64-bit hash."""
    return (hashes >> np.uint64(64 - bits)).astype(np.int64)


def collected(levels: DataFrame, bits: int, kind: type = np.uint8) -> np.ndarray:
    """``slot, level`` (from 1 to what ``kind`` holds, one row a slot at most) as one number for each of ``2 ** bits`` slots."""
    packed = levels.select(
        F.shiftright("slot", 12).alias("row"), F.struct((F.col("slot").bitwiseAND(F.lit(ROW - 1))).cast("int").alias("at"), F.col("level").cast("int").alias("level")).alias("x")
    )
    rows = packed.groupBy("row").agg(F.collect_list("x").alias("xs"))  # ROW entries at most
    out = np.zeros(1 << bits, kind)
    for row in rows.toLocalIterator():
        base = row.row * ROW
        for at, level in row.xs:
            out[base + at] = level
    return out


def task_counts(counts: np.ndarray) -> Iterator[pa.RecordBatch]:
    """A task's count of each slot as rows ``row, counts`` for ``frequency_levels``; rows of zeros are left out."""
    for row, part in enumerate(counts.reshape(-1, min(ROW, len(counts)))):
        if part.any():
            yield pa.RecordBatch.from_arrays([pa.array([row], pa.int32()), pa.array([part.astype("<i8").tobytes()])], ["row", "counts"])


def _row_levels(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``row, levels`` from ``row, counts`` of all tasks, sorted by row."""
    at, sums = None, None

    def answer() -> pa.RecordBatch:
        levels = np.where(sums > 0, frequency_level(np.maximum(sums, 1)), 0).astype(np.uint8)
        return pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), pa.array([levels.tobytes()])], ["row", "levels"])

    for batch in batches:
        for row, counts in zip(batch.column("row").to_pylist(), batch.column("counts").to_pylist(), strict=True):
            if row != at:
                if at is not None:
                    yield answer()
                at, sums = row, 0
            sums = sums + np.frombuffer(counts, "<i8")
    if at is not None:
        yield answer()


def frequency_level(n):
    """The level of a frequency above 0; it never falls as ``n`` rises."""
    return np.minimum(255, 1 + np.floor(8 * np.log2(n) + 0.5)).astype(np.int64)


def frequency_levels(counts: DataFrame, bits: int) -> np.ndarray:
    """Levels of frequency from ``row, counts`` of tasks (``task_counts``): 0 for none, else 1 + 8 * log2 of the sum, rounded."""
    rows = counts.repartition("row").sortWithinPartitions("row").mapInArrow(_row_levels, "row int, levels binary")
    out = np.zeros(1 << bits, np.uint8)
    for row in rows.toLocalIterator():
        levels = np.frombuffer(row.levels, np.uint8)
        out[row.row * len(levels) : (row.row + 1) * len(levels)] = levels
    return out


def presence(slots: DataFrame, bits: int) -> np.ndarray:
    """True for every slot that occurs in column ``slot``."""
    return collected(slots.select("slot").distinct().withColumn("level", F.lit(1)), bits).astype(bool)
