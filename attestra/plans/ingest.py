"""Land documents in Bronze, record the runs, report drift."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from attestra import fixed_values as fixed
from attestra import schemas
from attestra.operators import drift, landing, quarantine, registry
from attestra.operators.inventory import fingerprint, inventory
from attestra.operators.ordering import number_rows
from attestra.plans.lake import Lake
from attestra.session import broadcast_if_small, cut_lineage, text_bytes
from attestra.sources import sinks
from attestra.sources.documents import checked_records, records_only, snapshot_sources, split_documents

BRONZE_TABLE = f"{schemas.BRONZE}, attempt int, run_id string, ingest_date string, landing string"
DRIFT_EVENTS = (
    "run_id string, source string, kind string, severity string, path string, detail string, "
    "action_required string, confidence double, evidence string"
)
DOCUMENT_KEYS = ("run_id", "source_file", "source_sha256")


def ingest(
    spark: SparkSession, lake: Lake, paths: str | list[str], ingested_at: str, restart: bool = False, strict_enum: bool = False
) -> DataFrame:
    """Land every document under ``paths``; returns the manifests of the runs landed now.

    Run ids come from file content, so files that were landed before are skipped.
    ``restart`` lands them again as a new attempt; earlier attempts are kept.  ``strict_enum`` compares values
    of identical shapes too.
    """
    return land_files(spark, lake, snapshot_sources(spark, paths), ingested_at, restart, strict_enum)


def land_files(
    spark: SparkSession, lake: Lake, files: DataFrame, ingested_at: str, restart: bool = False, strict_enum: bool = False
) -> DataFrame:
    """Snapshot, one parse, Bronze, rejects, manifests, drift.

    The exact bytes are kept first and everything else reads them.  They are split and checked once; that
    table serves the shapes, Bronze, the rejects and the counts.  A record that cannot be landed is a row of
    ``rejects`` with its reason, bytes and place: it stops neither its file nor the others.
    """
    listed = files.groupBy("run_id").agg(F.min("path").alias("path"))
    attempt = 1
    if restart:
        attempt = (lake.runs(spark).agg(F.max("attempt").alias("a")).first()["a"] or 0) + 1
    else:
        landed = lake.runs(spark).where(F.col("status").isin("complete", "quarantined")).select("run_id")
        listed = listed.join(landed, "run_id", "left_anti")
    listed = cut_lineage(listed)
    count, mark = listed.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("run_id"))).first()
    if not count:
        return spark.createDataFrame([], schemas.RUNS)
    name = f"{attempt}-{count}-{mark % (1 << 64):016x}"

    arriving = files.join(broadcast_if_small(listed.select("path"), text_bytes("path")), "path", "left_semi")
    kept = arriving.select(*DOCUMENT_KEYS, "length", "content", F.lit(ingested_at).alias("ingested_at"), F.lit(name).alias("landing"))
    sinks.land(kept, lake.path("source_snapshots"))
    kept = lake.read(spark, "source_snapshots", schemas.SNAPSHOTS).where(F.col("landing") == name)
    split = cut_lineage(checked_records(split_documents(kept, DOCUMENT_KEYS)))
    records = records_only(split)

    shapes = inventory(records, ["run_id"])
    # One row per run landed now: its bytes are added up before it is broadcast, so that records are not shuffled.
    prints = cut_lineage(fingerprint(shapes, ["run_id"]).select("run_id", "schema_fingerprint"))
    stamped = records.join(broadcast_if_small(prints, text_bytes("run_id", "schema_fingerprint")), "run_id", "left")
    bronze = landing.envelope(stamped, F.lit(ingested_at), attempt).withColumn("landing", F.lit(name))
    sinks.land(bronze, lake.path("bronze"), "ingest_date")
    sinks.land(quarantine.rejects(split, ingested_at, attempt, name), lake.path("rejects"))

    manifests = cut_lineage(manifest(spark, lake, split, prints, ingested_at, attempt, name))
    sinks.append(manifests, lake.path("runs"))
    # The drift step runs after the data is safely in place.
    detect(spark, lake, manifests, shapes, ingested_at, strict_enum)
    return manifests


def manifest(spark: SparkSession, lake: Lake, split: DataFrame, prints: DataFrame, ingested_at: str, attempt: int, name: str) -> DataFrame:
    """What became of each run of a landing: records in the source are those written and those rejected."""
    day = F.col("ingest_date") == ingested_at[:10]
    written = lake.read(spark, "bronze", BRONZE_TABLE).where(day & (F.col("landing") == name))
    counted = landing.run_manifest(written)
    refused = split.where(F.col("reason").isNotNull()).groupBy("run_id").agg(
        F.count("record_index").alias("records_rejected"), F.lit(True).alias("_refused")
    )
    heads = split.where(F.col("record_index").isNull() & F.col("reason").isNull())
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c)
    nothing = F.col("_refused") & F.col("records_written").isNull()
    return (
        heads.join(counted, "run_id", "left")
        .join(refused, "run_id", "left")
        .join(prints, "run_id", "left")
        .select(
            "run_id",
            F.lit(attempt).alias("attempt"),
            "source_file",
            "source_sha256",
            "source_api_version",
            F.lit(ingested_at).alias("ingested_at"),
            F.when(nothing, "quarantined").otherwise("complete").alias("status"),
            "records_in_source",
            zero("records_written"),
            zero("unique_record_hashes"),
            zero("duplicates_from_replay"),
            "schema_fingerprint",
            F.lit(fixed.CONTRACT_VERSION).alias("contract_version"),
            "source",
            "source_metadata",
            F.lit(ingested_at).alias("completed_at"),
            zero("records_rejected"),
            F.lit(fixed.DELIVERY_GUARANTEE).alias("delivery_guarantee"),
            F.lit(name).alias("landing"),
        )
    )


def open_rejects(spark: SparkSession, lake: Lake) -> DataFrame:
    """Rejects that no correction has landed yet."""
    return quarantine.still_open(lake.read(spark, "rejects", schemas.REJECTS), lake.read(spark, "reject_resolutions", schemas.RESOLUTIONS))


def resubmit(spark: SparkSession, lake: Lake, corrections: DataFrame, resolved_at: str) -> DataFrame:
    """Land corrected records under the run, file and place of their rejects; returns a row per correction.

    Corrections are checked like any record.  What fails stays open; what was landed before lands no more.
    """
    tried = cut_lineage(quarantine.corrected(open_rejects(spark, lake), corrections))
    count, mark = tried.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("reject_id", "payload"))).first()
    name = f"resubmitted-{count}-{(mark or 0) % (1 << 64):016x}"
    prints = lake.runs(spark).groupBy("run_id", "attempt").agg(F.max("schema_fingerprint").alias("schema_fingerprint"))
    good = tried.where(F.col("reason").isNull()).join(prints, ["run_id", "attempt"], "left")
    rows = landing.envelope(good, F.lit(resolved_at), F.col("attempt")).withColumn("landing", F.lit(name))
    sinks.land(rows, lake.path("bronze"), "ingest_date")
    outcome = tried.select(
        "reject_id", "corrected_by", F.lit(resolved_at).alias("resolved_at"),
        F.when(F.col("reason").isNull(), "landed").otherwise("rejected").alias("outcome"), "reason", "record_hash",
    )
    sinks.append(outcome, lake.path("reject_resolutions"))
    return cut_lineage(outcome)


def detect(spark: SparkSession, lake: Lake, manifests: DataFrame, shapes: DataFrame, ingested_at: str, strict_enum: bool = False) -> DataFrame:
    """Compare each landed run with the one before it from its source; update the registry."""
    known = lake.snapshot(spark, "registry", schemas.REGISTRY)
    known_paths = lake.snapshot(spark, "registry_inventory", schemas.REGISTRY_INVENTORY)
    # Runs landed together follow each other by file name, then run id.
    batches = number_rows(manifests, ["source_file", "run_id"], "seq", ["source"]).select(
        "source",
        F.col("source_api_version").alias("api_version"),
        F.col("schema_fingerprint").alias("fingerprint"),
        "run_id",
        F.col("records_in_source").alias("record_count"),
        "ingested_at",
        "seq",
    )
    batches = cut_lineage(registry.baseline(batches, known, strict_enum))
    fields = ("path", "types", "present_count", "null_count", "values")
    changed = batches.where(F.col("baseline_kind") == "diff")
    new = shapes.join(changed.select("run_id"), "run_id", "left_semi").select("run_id", *fields)
    from_batch = changed.where(~F.col("from_registry")).select(
        F.col("run_id").alias("_to"), F.col("previous_run_id").alias("run_id")
    )
    from_registry = changed.where("from_registry").select(
        F.col("run_id").alias("_to"), "source", F.col("previous_version").alias("api_version")
    )
    old = (
        shapes.join(from_batch, "run_id").select(F.col("_to").alias("run_id"), *fields)
    ).unionByName(
        known_paths.join(from_registry, ["source", "api_version"]).select(F.col("_to").alias("run_id"), *fields)
    )
    events = drift.version_change(changed, ["run_id"]).unionByName(drift.diff_inventories(old, new, ["run_id"]))
    events = events.join(manifests.select("run_id", "source"), "run_id").select(
        "run_id", "source", *drift.EVENT
    )
    events = cut_lineage(events)
    sinks.append(events, lake.path("drift_events"))
    sinks.append(drift_reports(batches, events), lake.path("drift_reports"))
    arriving = shapes.join(batches.select("run_id", "source", "api_version", "seq"), "run_id").select(
        "source", "api_version", *fields, "seq"
    )
    lake.add_snapshot(registry.upsert(known, batches), "registry", ingested_at)
    lake.add_snapshot(registry.upsert_inventory(known_paths, arriving), "registry_inventory", ingested_at)
    return lake.read(spark, "drift_events", DRIFT_EVENTS)


def drift_reports(batches: DataFrame, events: DataFrame) -> DataFrame:
    """One row per landed run: what it was compared with, and whether a human must act."""
    gate = drift.drift_gate(events, ["run_id"])
    compared = (
        F.when(F.col("baseline_kind") == "none", "none (first batch from this source)")
        .when(F.col("baseline_kind") == "identical", F.concat("previous_version", F.lit(" (identical shape)")))
        .otherwise(F.col("previous_version"))
    )
    return batches.join(gate, "run_id", "left").select(
        F.col("ingested_at").alias("generated_at"),
        "run_id",
        "source",
        "api_version",
        compared.alias("compared_against"),
        F.col("fingerprint").alias("schema_fingerprint"),
        "record_count",
        F.coalesce("events", F.lit(0)).alias("events"),
        (F.coalesce("events", F.lit(0)) > 0).alias("drift_detected"),
        F.coalesce("requires_human_action", F.lit(False)).alias("requires_human_action"),
    )
