"""Bronze to Silver, its reports, and supersession proposals."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from attestra import fixed_values as fixed
from attestra import schemas
from attestra.operators import classify, history, landing, silver, supersession
from attestra.plans.ingest import BRONZE_TABLE
from attestra.plans.lake import Lake
from attestra.sources import sinks
from attestra.sources.tables import completed_only


def completed_bronze(spark: SparkSession, lake: Lake) -> DataFrame:
    """Records of completed runs, last attempts only."""
    runs = lake.runs(spark)
    return landing.latest_attempt(completed_only(lake.read(spark, "bronze", BRONZE_TABLE), runs), runs)


def normalise(spark: SparkSession, lake: Lake, aliases: dict[str, str]) -> DataFrame:
    """Rebuild Silver from all completed runs; returns it as written."""
    bronze = completed_bronze(spark, lake)
    unique = landing.dedupe_replays(bronze)
    place = {
        "review_group": F.coalesce(classify.review_category(F.col("clause_category")), F.lit("other")),
        "landed_on": F.coalesce(F.substring("_lineage.ingested_at", 1, 10), F.lit("")),
    }
    # Stored by category and day: a review reads the text of the places that hold open records only.
    sinks.rebuild(silver.to_silver(unique, aliases).withColumns(place), lake.path("silver"), partition_by=tuple(place))
    written = lake.silver(spark).drop(*place)
    sinks.rebuild(silver.normalisation_report(bronze, written), lake.path("normalisation_report"))
    sinks.rebuild(silver.null_counts(written, fixed.SILVER_ORDER), lake.path("null_counts"))
    sinks.rebuild(silver.issues(written), lake.path("normalisation_issues"))
    sinks.rebuild(silver.key_collisions(written), lake.path("key_collisions"))
    sinks.rebuild(silver.silver_versions(written), lake.path("silver_versions"))
    return written


HISTORY = f"{schemas.SILVER}, valid_from string, valid_to string, change_hash string, landed string, changed boolean, generation long"
REPLACED = "clause_id string, generation long, by long"
GENERATIONS = "generation long, committed_at string"


def silver_history(spark: SparkSession, lake: Lake) -> DataFrame:
    """Every version of every clause with the time it was valid (``valid_to`` null: current)."""
    rows = lake.read(spark, "silver_history", HISTORY)
    replaced = lake.read(spark, "silver_history_replaced", REPLACED)
    return history.current_rows(rows, replaced, lake.read(spark, "silver_history_generations", GENERATIONS), "clause_id")


def update_history(spark: SparkSession, lake: Lake, committed_at: str, arriving: DataFrame | None = None) -> DataFrame:
    """Merge Silver (or the rows of it that ``arriving`` gives) into its history; returns the history.

    A clause is valid from its last modification, or from its landing where it does not say.  Only clauses
    with a version that the history lacks are written again.  The generation's row is written last: a merge
    that broke off counts for nothing, and the next one replaces it.
    """
    rows = arriving if arriving is not None else lake.silver(spark)
    landed = F.col("_lineage.ingested_at")
    content = [*fixed.SILVER_ORDER, "_unmapped_fields"]
    new = history.versions(rows, "clause_id", F.coalesce("last_modified", landed), content, landed)
    generation = (lake.read(spark, "silver_history_generations", GENERATIONS).agg(F.max("generation").alias("g")).first()["g"] or 0) + 1
    merged, replaced = history.merge(silver_history(spark, lake), new, "clause_id")
    named = merged.withColumn("generation", F.lit(generation).cast("bigint"))
    sinks.replace_partition(named, lake.path("silver_history"), "generation")
    sinks.replace_partition(replaced.withColumn("by", F.lit(generation).cast("bigint")), lake.path("silver_history_replaced"), "by")
    sinks.append(spark.createDataFrame([(generation, committed_at)], GENERATIONS), lake.path("silver_history_generations"))
    return silver_history(spark, lake)


def propose_supersessions(spark: SparkSession, lake: Lake) -> DataFrame:
    """Write the proposals; Silver is left as it is."""
    written = lake.silver(spark)
    sinks.rebuild(supersession.proposals(written), lake.path("supersession_proposals"))
    return spark.read.parquet(lake.path("supersession_proposals"))
