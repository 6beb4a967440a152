"""Documents that keep arriving: landed once each, deduplicated, checked for drift."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.utils import StreamingQueryException

from attestra.plans.ingest import land_files
from attestra.plans.lake import Lake
from attestra.sources.documents import snapshot
from attestra.sources.tables import read_or_empty


class PausedByOperator(RuntimeError):
    """An operator asked the landing to stop between batches."""


def is_paused(spark: SparkSession, control_path: str | None) -> bool:
    """The newest control row decides; no control table means go on."""
    if control_path is None:
        return False
    rows = read_or_empty(spark, control_path, "requested_at string, paused boolean", "json")
    last = rows.orderBy(F.desc("requested_at")).limit(1).collect()
    return bool(last and last[0]["paused"])


def stream_documents(spark: SparkSession, folder: str, glob: str = "*.json") -> DataFrame:
    """New files of a folder as snapshot rows: exact bytes, digest and run id."""
    files = (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length bigint, content binary")
        .option("pathGlobFilter", glob)
        .load(folder)
    )
    return snapshot(files)


def start_landing(
    spark: SparkSession,
    lake: Lake,
    folder: str,
    clock: Callable[[int], str],
    control_path: str | None = None,
    strict_enum: bool = False,
) -> StreamingQuery:
    """Land all files that are there now, then stop (``availableNow``).

    The stream's checkpoint remembers the files; the landing's name, which follows from its runs, makes a
    replayed batch replace itself.  ``clock`` gives the ingestion time of a batch by its number.
    """

    def land(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        if is_paused(session, control_path):
            raise PausedByOperator(f"paused before batch {batch_id}")
        land_files(session, lake, batch, clock(batch_id), strict_enum=strict_enum)

    return (
        stream_documents(spark, folder)
        .writeStream.foreachBatch(land)
        .option("checkpointLocation", lake.path("_landing_checkpoint"))
        .trigger(availableNow=True)
        .start()
    )


def run_landing(
    spark: SparkSession,
    lake: Lake,
    folder: str,
    clock: Callable[[int], str],
    control_path: str | None = None,
    strict_enum: bool = False,
) -> str:
    """Run one landing to its end; ``complete`` or ``paused``."""
    query = start_landing(spark, lake, folder, clock, control_path, strict_enum)
    try:
        query.awaitTermination()
    except StreamingQueryException as stopped:
        if "PausedByOperator" in str(stopped):
            return "paused"
        raise
    return "complete"


def dedupe_stream(records: DataFrame, key: str = "record_hash", event_time: str | None = None, delay: str = "7 days") -> DataFrame:
    """Exactly once from at-least-once: by key for ever, or bounded by a watermark."""
    if event_time is None:
        return records.dropDuplicates([key])
    return records.withWatermark(event_time, delay).dropDuplicatesWithinWatermark([key])
