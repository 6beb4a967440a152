"""Table writes.  History is appended; rebuilt tables are overwritten; nothing is edited."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def land(rows: DataFrame, path: str, *partitions: str) -> None:
    """Write a landing under ``.../landing=<id>``, replacing what the same landing wrote before.

    The id follows from the runs that are landed together, so landing the same files again leaves the same
    table.  Rows are not shuffled by run: a run that holds a third of the table is written by all of its
    tasks, and a million small files make one folder.
    """
    replace_partition(rows, path, *partitions, "landing")


def replace_partition(df: DataFrame, path: str, *partitions: str) -> None:
    """Write the partitions that ``df`` holds; others stay."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partitions).parquet(path))


def append(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> None:
    writer = df.write.mode("append")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def rebuild(df: DataFrame, path: str, fmt: str = "parquet", partition_by: tuple[str, ...] = ()) -> None:
    """Replace a table that is fully derived from others."""
    writer = df.write.mode("overwrite").format(fmt)
    (writer.partitionBy(*partition_by) if partition_by else writer).save(path)


def export_sorted(df: DataFrame, path: str, *order: str) -> None:
    """A sorted JSON-lines export (range-partitioned sort, one file per range)."""
    df.orderBy(*order).write.mode("overwrite").json(path)
