"""What the operators of this package share: tables, shared folder, worker settings."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from attestra.session import configure, shared_folder

# Words are separated by the six ASCII white-space characters only.
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"


# Workers with these settings give arrays back to the system as soon as they are freed, at some cost in CPU.
LEAN = {
    "MALLOC_ARENA_MAX": "1",
    "MALLOC_MMAP_THRESHOLD_": str(2 << 20),
    "MALLOC_TRIM_THRESHOLD_": str(4 << 20),
    "ARROW_DEFAULT_MEMORY_POOL": "system",
}


def prepared(spark: SparkSession) -> SparkSession:
    """Runtime settings, small Arrow batches (texts are long), and workers that can import this package."""
    configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "4m")
    root = str(Path(__file__).resolve().parents[2])
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [known, root]))
    return spark


def lean_workers(spark: SparkSession) -> None:
    """For jobs of many steps, whose workers would keep what each step needed most."""
    spark.sparkContext.environment.update(LEAN)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepared(spark).read.parquet(f"{sf_dir}/documents.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: later steps never repeat what made it."""
    folder = shared_folder(df.sparkSession, name)
    # Writers hold a group of rows in memory before it goes out.
    df.write.option("parquet.block.size", 16 << 20).parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def own_columns(docs: DataFrame, *names: str) -> DataFrame:
    """Only the named columns of ``docs``; whatever else it carries cannot clash with ours."""
    return docs.select(*[docs[f"`{n}`"].alias(n) for n in names])


def text_key(text: Column) -> Column:
    """Equal for equal texts (null: empty), 32 bytes."""
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


def small_side(df: DataFrame, row_bytes: int | Column, limit_bytes: int = 8 << 20) -> DataFrame:
    """A written table as a join side: broadcast only if its bytes were counted and fit.

    ``row_bytes`` is the width of a row, or a column that gives it where rows differ.  Beyond
    ``limit_bytes`` the join shuffles (and splits hot keys, see ``attestra.session.RUNTIME``).
    """
    if isinstance(row_bytes, int):
        most = limit_bytes // row_bytes
        fits = df.limit(most + 1).count() <= most
    else:
        fits = (df.agg(F.sum(row_bytes)).first()[0] or 0) <= limit_bytes
    return F.broadcast(df) if fits else df
