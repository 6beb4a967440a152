"""Bronze: envelopes, run manifests, attempts, resume points and replay dedupe."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from attestra import fixed_values as fixed
from attestra.functions.json_values import record_hash
from attestra.session import broadcast_if_small, cut_lineage, text_bytes


def envelope(records: DataFrame, ingested_at: Column, attempt: int | Column = 1) -> DataFrame:
    """Metadata wraps the record and is never merged into it.

    ``records``: ``run_id, source_file, source_sha256, source_api_version, record_index,
    payload, schema_fingerprint``, and ``record_hash`` where it is known already.
    """
    known = "record_hash" in records.columns
    return records.select(
        F.struct(
            F.lit(fixed.CONTRACT_VERSION).alias("contract_version"),
            F.col("run_id"),
            F.col("source_file"),
            F.col("source_sha256"),
            F.col("source_api_version"),
            ingested_at.alias("ingested_at"),
            F.col("record_index"),
            (F.col("record_hash") if known else record_hash(F.col("payload"))).alias("record_hash"),
            F.col("schema_fingerprint"),
        ).alias("_bronze"),
        F.col("payload"),
        (F.lit(attempt) if isinstance(attempt, int) else attempt).alias("attempt"),
        F.substring(ingested_at, 1, 10).alias("ingest_date"),
        F.col("run_id"),
    )


def latest_attempt(bronze: DataFrame, attempts: DataFrame, run_col: str = "run_id") -> DataFrame:
    """Rows of each run's last attempt; earlier attempts stay in the table.

    ``attempts`` lists ``(run_id, attempt)``, one row per landing: the list is joined to the records,
    never the records grouped by run.  Runs it does not name are kept.
    """
    return bronze.join(superseded_attempts(attempts, run_col), [run_col, "attempt"], "left_anti")


def superseded_attempts(attempts: DataFrame, run_col: str = "run_id") -> DataFrame:
    newest = F.max("attempt").over(Window.partitionBy(run_col))
    return (
        attempts.withColumn("_newest", newest)
        .where(F.col("attempt") < F.col("_newest"))
        .select(run_col, "attempt")
        .distinct()
    )


def run_manifest(bronze: DataFrame, keys: tuple[str, ...] = ("run_id",), hash_col: str = "_bronze.record_hash") -> DataFrame:
    """Per run: rows written, distinct records, replayed duplicates."""
    counted = bronze.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("records_written"),
        F.count_distinct(F.col(hash_col)).alias("unique_record_hashes"),
    )
    return counted.withColumn(
        "duplicates_from_replay", F.col("records_written") - F.col("unique_record_hashes")
    )


def resume_points(bronze: DataFrame, keys: tuple[str, ...] = ("run_id",), index_col: str = "record_index") -> DataFrame:
    """Where an unfinished run goes on: its last committed index + 1."""
    return bronze.groupBy(*keys).agg((F.max(index_col) + 1).alias("resume_from_index"))


def keep_first(rows: DataFrame, key: str, order: tuple[str, ...]) -> DataFrame:
    """Replay dedupe: the first row of every ``key`` in ``order``.

    Replays are few, so the keys are counted on their own first and only the rows of repeated keys
    are shuffled; all other rows pass through with their payload where they are.  Among the repeated
    ones ``row_number() <= 1`` is pruned inside each input task before the shuffle, so a record
    replayed millions of times sends one row per task.
    """
    counted = rows.groupBy(key).agg(F.count(F.lit(1)).alias("_copies"))
    repeated = cut_lineage(counted.where(F.col("_copies") > 1).select(key))
    repeated = broadcast_if_small(repeated, text_bytes(key))
    ranked = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    first = rows.join(repeated, key, "left_semi").withColumn("_n", ranked).where(F.col("_n") <= 1)
    return rows.join(repeated, key, "left_anti").unionByName(first.drop("_n").select(*rows.columns))


def dedupe_replays(bronze: DataFrame) -> DataFrame:
    flat = bronze.select(
        "*",
        F.col("_bronze.record_hash").alias("_hash"),
        F.col("_bronze.record_index").alias("_index"),
    )
    return keep_first(flat, "_hash", ("ingest_date", "run_id", "attempt", "_index")).drop("_hash", "_index")
