"""Which records look replaced by a newer one, and which amend a record we never received."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attestra.functions.text import is_amendment, section_key


def supersessions(
    rows: DataFrame, group: Sequence[str], order: Sequence[Column], carried: Sequence[str]
) -> DataFrame:
    """Every row next to the newest row of its group (never row with row).

    Adds ``_newest`` (struct of ``carried``), ``_members`` and ``_is_newest``.  ``order`` must be total
    within a group.  Groups are aggregated before the shuffle, whatever their size, and their one row is
    joined back; the adaptive skew join splits the rows of a large one.
    """
    ordered = rows.withColumn("_order", F.struct(*order))
    newest = F.struct("_order", *carried)
    summary = ordered.groupBy(*[F.col(k).alias(f"_of_{k}") for k in group]).agg(
        F.max_by(newest, "_order").alias("_newest"), F.count(F.lit(1)).alias("_members")
    )
    same = F.lit(True)
    for k in group:
        same = same & ordered[k].eqNullSafe(summary[f"_of_{k}"])
    return (
        ordered.join(summary, same)
        .withColumn("_is_newest", F.col("_order") == F.col("_newest._order"))
        .drop("_order", *[f"_of_{k}" for k in group])
    )


def proposals(silver: DataFrame) -> DataFrame:
    """Supersession candidates and orphan amendments, all waiting for a human."""
    text = lambda name: F.coalesce(F.col(name), F.lit("")).alias(name)
    keyed = (
        silver.select(
            "clause_id",
            "contract_id",
            "section_ref",
            "last_modified",
            "review_history",
            F.coalesce(F.col("_lineage.record_hash"), F.lit("")).alias("_hash"),
            section_key(F.col("section_ref")).alias("section"),
        )
        .where(F.col("section").isNotNull())
        .withColumn("_contract", F.coalesce("contract_id", F.lit("")))
    )
    marked = supersessions(
        keyed,
        ["_contract", "section"],
        [text("last_modified"), text("clause_id"), F.col("_hash")],
        ["clause_id", "section_ref", "last_modified", "review_history"],
    )
    superseded = (F.col("_members") > 1) & ~F.col("_is_newest")
    orphan = (F.col("_members") == 1) & is_amendment(F.col("section_ref"))
    notes = F.coalesce(
        F.transform("_newest.review_history.reviews", lambda r: r["notes"]), F.array().cast("array<string>")
    )
    pair = lambda value: F.when(superseded, value)
    return marked.where(superseded | orphan).select(
        F.concat(F.when(superseded, "SUP-").otherwise("ORPHAN-"), "clause_id").alias("proposal_id"),
        F.when(superseded, "SUPERSESSION_CANDIDATE").otherwise("AMENDS_UNKNOWN_CLAUSE").alias("kind"),
        F.lit("PENDING_HUMAN_REVIEW").alias("status"),
        "contract_id",
        "section",
        F.when(~superseded, F.col("clause_id")).alias("clause_id"),
        pair(F.col("clause_id")).alias("superseded_clause_id"),
        pair(F.col("_newest.clause_id")).alias("superseding_clause_id"),
        F.struct(
            superseded.alias("same_contract_and_section"),
            pair(F.col("_newest.section_ref")).alias("superseding_section_ref"),
            F.col("section_ref").alias("superseded_section_ref"),
            pair(is_amendment(F.col("_newest.section_ref"))).alias("superseding_marked_amended"),
            pair(F.col("last_modified")).alias("superseded_last_modified"),
            pair(F.col("_newest.last_modified")).alias("superseding_last_modified"),
            pair(notes).alias("superseding_review_notes"),
        ).alias("evidence"),
    )


def in_report_order(found: DataFrame) -> DataFrame:
    """By contract and section, older records first."""
    return found.orderBy("contract_id", "section", "evidence.superseded_last_modified", "proposal_id")
