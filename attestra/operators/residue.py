"""The second pass: findings that need interpretation, merged below the rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attestra import fixed_values as fixed
from attestra import schemas
from attestra.functions import severity
from attestra.functions.binding import bind, evaluated_once
from attestra.functions.text import strip_code_fence

ASSESSMENT = (
    f"struct<findings:array<{schemas.FINDING}>,overall_severity:string,confidence:double,notes:string>"
)
ASSESSMENT_JSON = (
    f"findings array<{schemas.FINDING}>, overall_severity string, confidence double, notes string"
)
CLASSIFICATION_JSON = "category string, confidence double, reasoning string, signals array<string>"


def _finding(texts: tuple) -> Column:
    risk, level, confidence, reference, observed, expected, alternative = texts
    return F.struct(
        F.lit(risk).alias("risk"),
        F.lit(level).alias("severity"),
        F.lit(confidence).alias("confidence"),
        F.lit(reference).cast("string").alias("standard_reference"),
        F.lit(observed).alias("observed"),
        F.lit(expected).alias("expected"),
        F.lit(alternative).alias("suggested_alternative"),
        F.array().cast("array<string>").alias("precedent_clause_ids"),
    ).cast(schemas.FINDING)


def narrative_assessment(lowered: Column) -> Column:
    """Assessment struct from wording that a number cannot measure."""
    discretion = F.lit(False)
    for phrase in fixed.DISCRETION_PHRASES:
        discretion = discretion | lowered.contains(phrase)
    fault = F.lit(True)
    for phrase in fixed.FAULT_PHRASES:
        fault = fault & lowered.contains(phrase)
    found = F.array_compact(
        F.array(
            F.when(discretion, _finding(fixed.RESIDUE_DISCRETION)),
            F.when(fault, _finding(fixed.RESIDUE_FAULT)),
        )
    ).cast(f"array<{schemas.FINDING}>")
    return bind(
        found,
        lambda f: F.struct(
            f.alias("findings"),
            severity.worst(f).alias("overall_severity"),
            F.when(F.size(f) > 0, fixed.RESIDUE_CONFIDENCE_WITH_FINDINGS)
            .otherwise(fixed.RESIDUE_CONFIDENCE_CLEAN)
            .alias("confidence"),
            F.lit("Narrative pass only; policy-based findings come from the rules.").alias("notes"),
        ).cast(ASSESSMENT),
    )


def _in_unit(value: Column) -> Column:
    return F.coalesce(value.between(0.0, 1.0), F.lit(False))


def parse_classification(content: Column) -> Column:
    """Model text -> classification struct, or null when it is not usable as it stands.

    Required fields must be there and in range; a wrong category is a failure, not a default.
    """

    def check(m: Column) -> Column:
        parsed = m["parsed"]
        usable = (
            m["object"]
            & parsed["category"].isin(*fixed.REVIEW_CATEGORIES)
            & _in_unit(parsed["confidence"])
            & parsed["reasoning"].isNotNull()
        )
        return F.when(
            F.coalesce(usable, F.lit(False)),
            F.struct(
                parsed["category"].alias("category"),
                parsed["confidence"].alias("confidence"),
                parsed["reasoning"].alias("reasoning"),
                F.coalesce(parsed["signals"], F.array().cast("array<string>")).alias("signals"),
            ),
        )

    return bind(_read(content, CLASSIFICATION_JSON), check)


def _read(content: Column, ddl: str) -> Column:
    """Struct ``(object, parsed)`` of a model text, each worked out once."""
    return bind(
        strip_code_fence(content),
        lambda text: F.struct(
            F.schema_of_variant(F.try_parse_json(text)).startswith("OBJECT").alias("object"),
            F.from_json(text, ddl).alias("parsed"),
        ),
    )


def parse_assessment(content: Column) -> Column:
    """Model text -> assessment struct, or null when any part of it is not usable."""
    levels = list(fixed.SEVERITY_RANK)

    def complete(f: Column) -> Column:
        return (
            f["risk"].isNotNull()
            & F.coalesce(f["severity"].isin(levels), F.lit(False))
            & _in_unit(f["confidence"])
            & f["suggested_alternative"].isNotNull()
        )

    def check(m: Column) -> Column:
        parsed = m["parsed"]
        findings = F.coalesce(parsed["findings"], F.array().cast(f"array<{schemas.FINDING}>"))
        overall = F.coalesce(parsed["overall_severity"], F.lit("none"))
        confidence = F.coalesce(parsed["confidence"], F.lit(1.0))
        usable = m["object"] & F.forall(findings, complete) & overall.isin(levels) & _in_unit(confidence)
        return F.when(
            F.coalesce(usable, F.lit(False)),
            F.struct(
                findings.alias("findings"),
                overall.alias("overall_severity"),
                confidence.alias("confidence"),
                parsed["notes"].alias("notes"),
            ).cast(ASSESSMENT),
        )

    return bind(_read(content, ASSESSMENT_JSON), check)


def merge_assessment(
    rows: DataFrame,
    assessment: Column,
    gated: Column,
    findings: str = "findings",
    min_confidence: float = fixed.ESCALATE_BELOW_CONFIDENCE,
    model_decided_by: Column | None = None,
) -> DataFrame:
    """Rule findings first, then the model findings no rule raised on the same standard.

    Replaces ``findings`` and ``overall_severity``; adds ``risk_confidence``,
    ``risk_decided_by``, ``risk_status``, ``risk_reason``, ``risk_notes`` and
    ``dropped_findings``.  ``assessment`` null on a gated row means the model output failed: the
    rule findings stay and the row is escalated.
    """
    model_decided_by = F.lit("model") if model_decided_by is None else model_decided_by
    none = F.array().cast(f"array<{schemas.FINDING}>")
    staged = rows.withColumn("_gated", gated).withColumn("_model", F.when(F.col("_gated"), assessment))
    raised = F.transform(findings, lambda f: f["standard_reference"])
    offered = F.coalesce(F.col("_model.findings"), none)
    kept = F.filter(
        offered,
        lambda f: f["standard_reference"].isNull()
        | (f["standard_reference"] == "")
        | ~F.coalesce(F.array_contains(raised, f["standard_reference"]), F.lit(False)),
    )
    staged = staged.withColumn("_kept", kept).withColumn(
        "dropped_findings", F.size(offered) - F.size("_kept")
    )
    failed = F.col("_gated") & F.col("_model").isNull()
    confidence = F.when(F.size("_kept") > 0, F.least(F.lit(1.0), F.col("_model.confidence"))).otherwise(1.0)
    reason = F.when(failed, "unparseable_model_output").when(
        F.col("_gated") & (F.size("_kept") > 0) & (F.col("_model.confidence") < min_confidence),
        "low_confidence_risk_assessment",
    )
    staged = evaluated_once(staged)
    return (
        staged.withColumn(findings, F.concat(findings, "_kept"))
        .withColumn("overall_severity", severity.worst(F.col(findings)))
        .withColumn("risk_confidence", confidence)
        .withColumn(
            "risk_decided_by", F.when(~F.col("_gated") | failed, F.lit("rule")).otherwise(model_decided_by)
        )
        .withColumn("risk_reason", reason)
        .withColumn("risk_status", F.when(F.col("risk_reason").isNull(), "proposed").otherwise("escalated"))
        .withColumn(
            "risk_notes",
            F.when(~F.col("_gated"), F.lit("Outside the risk-bearing categories; rules only."))
            .when(failed, F.lit("Model pass failed; deterministic findings retained."))
            .otherwise(F.col("_model.notes")),
        )
        .drop("_gated", "_model", "_kept")
    )
