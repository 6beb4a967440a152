"""Records that could not be landed: why, where, and what became of them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from attestra.sources.documents import checked_records


def rejects(split: DataFrame, ingested_at: str, attempt: int, landing: str) -> DataFrame:
    """One row per rejected piece of a split document, named by its run, attempt and place."""
    place = F.concat_ws(":", "run_id", F.lit(attempt), F.coalesce(F.col("record_index").cast("string"), F.lit("-")), "byte_offset", "reason")
    return split.where(F.col("reason").isNotNull()).select(
        F.sha2(place, 256).alias("reject_id"),
        "run_id",
        F.lit(attempt).alias("attempt"),
        "source_file",
        "source_sha256",
        "source_api_version",
        F.lit(ingested_at).alias("ingested_at"),
        "record_index",
        "byte_offset",
        "bytes",
        "reason",
        "raw",
        F.lit(landing).alias("landing"),
    )


def still_open(rejected: DataFrame, resolutions: DataFrame) -> DataFrame:
    """Rejects without a correction that was landed."""
    landed = resolutions.where(F.col("outcome") == "landed").select("reject_id")
    return rejected.join(landed, "reject_id", "left_anti")


def corrected(rejected: DataFrame, corrections: DataFrame) -> DataFrame:
    """Corrections (``reject_id, payload, corrected_by``) of open rejects, checked: ``reason`` is null for a good one.

    Parts of a document that are no record cannot be corrected, nor can ids that are unknown; of several
    corrections of a reject the smallest text counts.
    """
    first = F.row_number().over(Window.partitionBy("reject_id").orderBy("payload", "corrected_by"))
    one = corrections.withColumn("_n", first).where(F.col("_n") == 1).select("reject_id", "payload", "corrected_by")
    asked = rejected.where(F.col("record_index").isNotNull()).drop("reason", "raw", "bytes", "ingested_at", "landing").join(one, "reject_id")
    text = F.coalesce("payload", F.lit(""))
    rows = asked.withColumn("payload", text).withColumn("raw", F.lit(None).cast("binary")).withColumn("reason", F.lit(None).cast("string"))
    return checked_records(rows)


def reject_counts(rejected: DataFrame, *keys: str) -> DataFrame:
    """Records and other parts rejected, and their bytes, by ``keys`` and reason."""
    return rejected.groupBy(*keys, "reason").agg(
        F.count("record_index").alias("records"),
        F.count_if(F.col("record_index").isNull()).alias("parts"),
        F.sum("bytes").alias("bytes"),
    )
