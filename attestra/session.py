"""Session settings and lineage cuts."""

from __future__ import annotations

import os
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Runtime settings every job here relies on.  Timestamps are rendered as UTC text, hot join keys
# are split by the adaptive skew join, and generated methods stay small enough to be compiled by
# the JVM (rule expressions are long; beyond 8,000 bytecodes they would be interpreted).
RUNTIME = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for key, value in RUNTIME.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = 8, partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A single-JVM session for tests and local benchmarks."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("attestra")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the one every executor can reach; in local mode, without one, a temporary folder.

    That is ``spark.checkpoint.dir``, or the folder the context was given.  Files there must outlive whatever
    reads them; whoever owns the folder clears it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        base = tempfile.mkdtemp(prefix="run-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def reachable(spark: SparkSession) -> None:
    """Workers import this package from where the driver did."""
    root = str(Path(__file__).resolve().parents[1])
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [known, root]))


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder as Parquet and read it back: later steps repeat nothing and prune columns."""
    folder = shared_folder(df.sparkSession, "step")
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def broadcast_if_small(df: DataFrame, row_bytes: Column, max_bytes: int = 8 << 20) -> DataFrame:
    """Hint a broadcast only after adding up the bytes of the rows: beyond ``max_bytes`` the join shuffles.

    Give it a materialised (checkpointed or written) table, so the sum is cheap.
    """
    total = df.agg(F.sum(row_bytes)).first()[0] or 0
    return F.broadcast(df) if total <= max_bytes else df


def text_bytes(*columns: str) -> Column:
    """Bytes of a row of short texts: what they hold and a fixed part."""
    size = F.lit(32).cast("bigint")
    for c in columns:
        size = size + F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0))
    return size
