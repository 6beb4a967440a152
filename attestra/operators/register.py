"""The published risk register: one row per input record, whatever happened to it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attestra import schemas
from attestra.operators.classify import review_required

NO_FINDINGS = f"array<{schemas.FINDING}>"


def register(silver: DataFrame, decided: DataFrame, superseded: DataFrame | None = None) -> DataFrame:
    """Silver left-joined to the decisions: a record without one reads ``not_processed``.

    ``decided``: ``clause_id, record_hash, review_category, classification_confidence,
    classification_decided_by, findings, overall_severity, status``, one row a record; ``superseded``:
    ``clause_id, superseded_by``, one row an id.  Records that share an id are told apart by their
    hash, so every row of Silver gives one row.  Whether a review is
    pending follows from the severity, so a resumed run publishes the same.
    """
    base = silver.select(
        "clause_id",
        F.coalesce("contract_id", F.lit("")).alias("contract_id"),
        F.coalesce("client_name", F.lit("")).alias("client_name"),
        F.coalesce("section_ref", F.lit("")).alias("section_ref"),
        F.col("clause_category").alias("source_category"),
        F.col("_lineage").alias("lineage"),
        F.coalesce("_lineage.record_hash", F.lit("")).alias("record_hash"),
    )
    joined = base.join(decided, ["clause_id", "record_hash"], "left")
    if superseded is not None:
        joined = joined.join(superseded, "clause_id", "left")
    else:
        joined = joined.withColumn("superseded_by", F.lit(None).cast("string"))
    overall = F.coalesce("overall_severity", F.lit("none"))
    return joined.select(
        "clause_id",
        "contract_id",
        "client_name",
        "section_ref",
        "source_category",
        "review_category",
        "classification_confidence",
        "classification_decided_by",
        overall.alias("overall_severity"),
        F.coalesce("findings", F.array().cast(NO_FINDINGS)).alias("findings"),
        F.coalesce("status", F.lit("not_processed")).alias("status"),
        F.when(review_required(overall), "pending").otherwise("not_required").alias("review_status"),
        "superseded_by",
        "lineage",
    )


def run_summary(gold: DataFrame) -> DataFrame:
    """One row of run totals from the register."""
    state = F.col("status")
    level = F.col("overall_severity")
    return gold.agg(
        F.count(F.lit(1)).alias("clauses_total"),
        F.count_if(state != "not_processed").alias("clauses_processed"),
        F.count_if(state == "not_processed").alias("clauses_not_processed"),
        F.count_if(state == "escalated").alias("escalated"),
        F.count_if(state == "overridden").alias("overridden"),
        F.count_if(level == "high").alias("severity_high"),
        F.count_if(level == "medium").alias("severity_medium"),
        F.count_if(level == "low").alias("severity_low"),
        F.count_if(level == "none").alias("severity_none"),
        F.count_if(F.col("review_status") == "pending").alias("review_pending"),
    )


def health_signals(ledger: DataFrame) -> DataFrame:
    """Share of rule decisions, cost per record and share of human decisions over a ledger."""
    records = F.count_distinct("clause_id")
    return ledger.agg(
        F.count(F.lit(1)).alias("decisions"),
        F.round(F.avg(F.when(F.col("decided_by") == "rule", 1.0).otherwise(0.0)), 4).alias("rule_share"),
        F.round(F.avg(F.when(F.col("decided_by") == "human", 1.0).otherwise(0.0)), 4).alias("human_share"),
        F.round(
            F.try_divide(F.sum(F.col("usage.cost_usd").cast("decimal(28,8)")).cast("double"), records), 8
        ).alias("cost_per_record"),
    )


def override_rate(findings: DataFrame, overrides: DataFrame) -> DataFrame:
    """Per standard: how often it is raised, how often people overrule it."""
    raised = findings.groupBy("standard_reference").agg(F.count(F.lit(1)).alias("raised"))
    overruled = (
        overrides.where(F.col("field").startswith("risk.findings."))
        .select(F.substr("field", F.lit(len("risk.findings.") + 1)).alias("standard_reference"))
        .groupBy("standard_reference")
        .agg(F.count(F.lit(1)).alias("overruled"))
    )
    return raised.join(overruled, "standard_reference", "left").select(
        "standard_reference",
        "raised",
        F.coalesce("overruled", F.lit(0)).alias("overruled"),
        F.round(F.coalesce("overruled", F.lit(0)) / F.col("raised"), 4).alias("override_rate"),
    )
