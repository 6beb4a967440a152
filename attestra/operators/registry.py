"""The schema registry: last known shape per source and version."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attestra.operators.ordering import beside

REGISTRY_COLUMNS = (
    "source",
    "api_version",
    "fingerprint",
    "first_seen",
    "last_seen",
    "last_run_id",
    "record_count",
    "is_latest",
)


def baseline(batches: DataFrame, registry: DataFrame, strict_enum: bool = False) -> DataFrame:
    """Add ``previous_version``, ``previous_run_id`` and ``baseline_kind`` to each batch.

    ``batches``: ``source, api_version, fingerprint, run_id, seq``; a batch is compared with the one
    landed before it from the same source, here or earlier.  Kinds: ``none`` (first batch),
    ``identical`` (same version, same shape) and ``diff``.  The fingerprint covers paths and types
    only; ``strict_enum`` compares identical shapes too, so a new label is reported as well.
    """
    landed = registry.where("is_latest").select(
        "source",
        "api_version",
        "fingerprint",
        F.col("last_run_id").alias("run_id"),
        F.lit(-1).cast("bigint").alias("seq"),
    )
    arriving = batches.select("source", "api_version", "fingerprint", "run_id", F.col("seq").cast("bigint").alias("seq"))
    # A source may land any number of batches: the one before is carried over order ranges.
    before = {f"previous_{c}": F.col(c) for c in ("api_version", "fingerprint", "run_id", "seq")}
    chained = beside(landed.unionByName(arriving), ["source"], ["seq"], before).select("source", "run_id", "seq", *before)
    same = (F.col("previous_version") == F.col("api_version")) & (
        F.col("previous_fingerprint") == F.col("fingerprint")
    )
    return (
        batches.join(
            chained.where("seq >= 0")
            .drop("seq")
            .withColumnRenamed("previous_api_version", "previous_version"),
            ["source", "run_id"],
        )
        .withColumn(
            "baseline_kind",
            F.when(F.col("previous_version").isNull(), "none")
            .when(same & F.lit(not strict_enum), "identical")
            .otherwise("diff"),
        )
        .withColumn("from_registry", F.col("previous_seq") == -1)
        .drop("previous_seq")
    )


def upsert(registry: DataFrame, batches: DataFrame) -> DataFrame:
    """The registry after ``batches`` (in ``seq`` order per source): latest row per key.

    ``first_seen`` is kept from the oldest row, everything else comes from the newest batch, and
    the last batch of a source becomes its latest version.
    """
    arriving = batches.select(
        "source",
        "api_version",
        "fingerprint",
        F.col("ingested_at").alias("first_seen"),
        F.col("ingested_at").alias("last_seen"),
        F.col("run_id").alias("last_run_id"),
        F.col("record_count").cast("bigint").alias("record_count"),
        F.lit(False).alias("is_latest"),
        (F.col("seq") + 1).cast("bigint").alias("_age"),
    )
    known = registry.select(*REGISTRY_COLUMNS, F.lit(0).cast("bigint").alias("_age"))
    newest = F.struct("fingerprint", "last_seen", "last_run_id", "record_count", "is_latest", "_age")
    merged = (
        known.unionByName(arriving)
        .groupBy("source", "api_version")
        .agg(F.max_by(newest, "_age").alias("n"), F.min_by("first_seen", "_age").alias("first_seen"))
    )
    last = arriving.groupBy("source").agg(F.max("_age").alias("_last"))
    return merged.join(last, "source", "left").select(
        "source",
        "api_version",
        "n.fingerprint",
        "first_seen",
        "n.last_seen",
        "n.last_run_id",
        "n.record_count",
        F.when(F.col("_last").isNotNull(), F.col("n._age") == F.col("_last"))
        .otherwise(F.col("n.is_latest"))
        .alias("is_latest"),
    )


def upsert_inventory(known: DataFrame, arriving: DataFrame) -> DataFrame:
    """Replace the inventory of every (source, api_version) that arrives; the last batch wins.

    ``arriving`` has the columns of ``known`` plus ``seq``.
    """
    last = arriving.groupBy("source", "api_version").agg(F.max("seq").alias("seq"))
    newest = arriving.join(last, ["source", "api_version", "seq"], "left_semi")
    kept = known.join(last, ["source", "api_version"], "left_anti")
    return kept.unionByName(newest.select(*known.columns))
