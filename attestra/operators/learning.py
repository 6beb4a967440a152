"""Repeated overrides become proposals; only a named person turns one into a new policy."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from attestra import fixed_values as fixed
from attestra.operators.ledger import ledger_rows

PREFIX = "risk.findings."


def _reference(field: Column) -> Column:
    return F.when(field.startswith(PREFIX), F.substr(field, F.lit(len(PREFIX) + 1)))


def override_patterns(overrides: DataFrame, min_occurrences: int = fixed.MIN_OVERRIDES_FOR_PROPOSAL) -> DataFrame:
    """Standards that people keep overruling: ``(standard_reference, occurrences)``."""
    return (
        overrides.select(_reference(F.col("field")).alias("standard_reference"))
        .where(F.col("standard_reference").isNotNull())
        .groupBy("standard_reference")
        .agg(F.count(F.lit(1)).alias("occurrences"))
        .where(F.col("occurrences") >= min_occurrences)
    )


def proposal_id(reference: Column) -> Column:
    """``LP-<section>-<key>``, split at the first dot."""
    section = F.substring_index(reference, ".", 1)
    return F.concat(F.lit("LP-"), section, F.lit("-"), F.substr(reference, F.length(section) + 2))


def learning_proposals(
    overrides: DataFrame, policy_rows: DataFrame, created_at: str,
    min_occurrences: int = fixed.MIN_OVERRIDES_FOR_PROPOSAL,
) -> DataFrame:
    """One proposal per pattern.  The value stays; documented exceptions are proposed.

    The evidence is ``proposal_evidence``, one row per override: a standard overruled millions
    of times does not become one cell.
    """
    patterns = override_patterns(overrides, min_occurrences)
    standards = policy_rows.select(
        F.concat_ws(".", "section", "key").alias("standard_reference"), F.col("value").alias("current_value")
    )
    return patterns.join(standards, "standard_reference", "left").select(
        proposal_id(F.col("standard_reference")).alias("proposal_id"),
        F.lit(created_at).alias("created_at"),
        F.lit("PENDING_HUMAN_APPROVAL").alias("status"),
        F.lit("adjust_firm_standard").alias("kind"),
        F.format_string(
            fixed.PROPOSAL_SUMMARY,
            "standard_reference",
            "occurrences",
        ).alias("summary"),
        "standard_reference",
        "occurrences",
        "current_value",
        # The exceptions to be added are the rows of ``proposal_evidence``.
        F.to_json(F.struct(F.col("current_value").alias("value"), F.lit("proposal_evidence").alias("exceptions"))).alias("proposed_value"),
        F.lit("policy").alias("target_file"),
        F.lit(fixed.PROPOSAL_RATIONALE).alias("rationale"),
        F.lit(fixed.PROPOSAL_RISK).alias("risk_if_applied"),
    )


def proposal_evidence(overrides: DataFrame, proposals: DataFrame) -> DataFrame:
    """The overrides behind each proposal, in override order (``seq``), with their exception text."""
    cited = overrides.withColumn("standard_reference", _reference(F.col("field")))
    return cited.join(proposals.select("standard_reference", "proposal_id"), "standard_reference").select(
        "proposal_id",
        "seq",
        "override_id",
        "clause_id",
        F.format_string(
            fixed.EXCEPTION_TEXT, "clause_id", "reviewer", F.coalesce("rationale", F.lit(""))
        ).alias("exception"),
    )


def bumped_version(version: Column) -> Column:
    """``major.minor.patch`` -> ``major.(minor + 1).0``; missing parts count as 0."""
    parts = F.split(version, r"\.")
    minor = F.coalesce(F.get(parts, F.lit(1)).cast("int"), F.lit(0))
    return F.concat(parts[0], F.lit("."), (minor + 1).cast("string"), F.lit(".0"))


def check_approval(proposals: DataFrame, wanted: str, approved_by: str | None) -> Row:
    """The proposal to apply, or an error: it must exist, be pending and have an approver."""
    if not approved_by:
        raise ValueError("an approver must be named; use policy_diff to look at the change")
    found = proposals.where(F.col("proposal_id") == wanted).limit(2).collect()
    states = [r["status"] for r in found]
    if states != ["PENDING_HUMAN_APPROVAL"]:
        raise ValueError(f"{wanted}: expected one pending proposal, found {states}")
    return found[0]


def policy_diff(policy_rows: DataFrame, proposal: DataFrame, evidence: DataFrame) -> DataFrame:
    """What would change, as rows; nothing is changed."""
    change = proposal.select("proposal_id", "standard_reference")
    kept = (
        policy_rows.withColumn("standard_reference", F.concat_ws(".", "section", "key"))
        .join(change, "standard_reference")
        .select("proposal_id", "standard_reference", F.lit("value").alias("field"),
                F.col("value").alias("before"), F.col("value").alias("after"), F.lit(0).cast("bigint").alias("seq"))
    )
    added = evidence.join(change, "proposal_id").select(
        "proposal_id", "standard_reference", F.lit("exceptions").alias("field"),
        F.lit(None).cast("string").alias("before"), F.col("exception").alias("after"), "seq",
    )
    return kept.unionByName(added)


def apply_proposal(
    policy_rows: DataFrame, proposals: DataFrame, evidence: DataFrame, proposal_id: str, approved_by: str | None,
    rationale: str, timestamp: str,
) -> dict[str, DataFrame]:
    """An approved change as new rows; the earlier policy version stays in the table.

    Returns ``policy`` (version n + 1), ``exceptions`` (new exception rows), ``history``,
    ``approvals``, ``proposals`` (with the new status) and ``ledger``, each to be appended.
    """
    chosen = check_approval(proposals, proposal_id, approved_by)
    # One proposal and one standard: their values are literals below, nothing is joined to them.
    reference = F.concat_ws(".", "section", "key")
    known = policy_rows.where(reference == chosen["standard_reference"])
    standards = known.select("section", "key", bumped_version(F.col("version")).alias("next")).limit(2).collect()
    if not standards:
        raise ValueError(f"{proposal_id}: the policy has no such standard")
    new_version = bumped_version(F.col("version"))
    policy = policy_rows.withColumn("version", new_version)
    exceptions = evidence.where(F.col("proposal_id") == proposal_id).select(
        F.lit(standards[0]["next"]).alias("version"),
        F.lit(standards[0]["section"]).alias("section"),
        F.lit(standards[0]["key"]).alias("key"),
        F.col("seq").alias("position"),
        F.col("exception").alias("text"),
    )
    change = known.select(
        F.lit(proposal_id).alias("proposal_id"),
        F.col("version").alias("version_from"),
        new_version.alias("version_to"),
        "section",
        "key",
        "value",
        F.lit(chosen["summary"]).alias("summary"),
        F.lit(chosen["occurrences"]).cast("bigint").alias("occurrences"),
    )
    history = change.select(
        F.col("version_to").alias("version"),
        F.lit(timestamp).alias("date"),
        F.lit(approved_by).alias("approved_by"),
        "proposal_id",
        F.coalesce(F.nullif(F.lit(rationale), F.lit("")), F.col("summary")).alias("note"),
    )
    approved = change.select(
        F.concat(F.lit("APR-"), "proposal_id").alias("approval_id"),
        F.lit(timestamp).alias("timestamp"),
        "proposal_id",
        F.lit(approved_by).alias("approved_by"),
        F.lit(rationale).alias("rationale"),
        "version_from",
        "version_to",
        "occurrences",
        "section",
        "key",
        "value",
    )
    approvals = approved.drop("section", "key", "value")
    applied = proposals.withColumn(
        "status",
        F.when(F.col("proposal_id") == proposal_id, "APPROVED_AND_APPLIED").otherwise(F.col("status")),
    )
    ledger = ledger_rows(
        approved,
        agent="human_approval",
        action="apply_learning_proposal",
        clause_id=F.lit("-"),
        decided_by=F.lit("human"),
        status=F.lit("accepted"),
        run_id="manual",
        timestamp=timestamp,
        human_decision=F.to_json(
            F.struct("approval_id", "proposal_id", F.col("approved_by").alias("reviewer"), "rationale",
                     "version_from", "version_to")
        ),
        effective_value=F.to_json(F.struct("section", "key", "value")),
        detail=F.format_string(
            "%s approved %s. Policy v%s -> v%s. This is the only path by which system behaviour changes.",
            "approved_by", "proposal_id", "version_from", "version_to",
        ),
    )
    return {
        "policy": policy,
        "exceptions": exceptions,
        "history": history,
        "approvals": approvals,
        "proposals": applied,
        "ledger": ledger,
    }


def acknowledge_halt(spark: SparkSession, run_id: str, reason: str, halt_reason: str, timestamp: str) -> DataFrame:
    """A ledger row that says a person looked at a halt before the run went on."""
    one = spark.range(1)
    return ledger_rows(
        one,
        agent="operator",
        action="acknowledge_halt",
        clause_id=F.lit("-"),
        decided_by=F.lit("human"),
        status=F.lit("accepted"),
        run_id=run_id,
        timestamp=timestamp,
        human_decision=F.to_json(F.struct(F.lit(reason).alias("reason"), F.lit(halt_reason).alias("halt_reason"))),
    )

