"""Human decisions: collecting them, reconciling them with the assessments, overrides."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attestra import fixed_values as fixed

from attestra.functions import severity
from attestra.operators.ledger import ledger_rows, record_lineage
from attestra.operators.ordering import number_rows
from attestra.session import cut_lineage

COLUMNS = ("clause_id", "reviewer", "date", "action", "field", "human_value", "rationale", "source")


def named_record(rows: DataFrame) -> Column:
    """The hash of the record a row is about; null, where it names none, means all records of its id."""
    if "record_hash" in rows.columns:
        return F.col("record_hash")
    lineage = [c for c in ("_lineage", "lineage") if c in rows.columns]
    return F.coalesce(f"{lineage[0]}.record_hash", F.lit("")) if lineage else F.lit(None).cast("string")


def human_reviews(silver: DataFrame, simulated: DataFrame | None = None, order: Sequence[str] = ("clause_id",)) -> DataFrame:
    """All human decisions from both sources, labelled; ordered by ``_source, _key, _pos``.

    ``simulated`` has the same fields plus ``position``, and ``record_hash`` if it names records.  A review
    in a record's own history is about that record.
    """
    history = silver.select(
        "clause_id",
        named_record(silver).alias("record_hash"),
        F.concat_ws("|", *order).alias("_key"),
        F.posexplode("review_history.reviews").alias("_pos", "r"),
    ).select(
        "clause_id",
        "record_hash",
        F.coalesce("r.reviewer", F.lit("unknown")).alias("reviewer"),
        F.col("r.date").alias("date"),
        F.col("r.action").alias("action"),
        F.lit(None).cast("string").alias("field"),
        F.lit(None).cast("string").alias("human_value"),
        F.coalesce("r.notes", F.lit("")).alias("rationale"),
        F.lit("review_history").alias("source"),
        F.lit(0).alias("_source"),
        "_key",
        F.col("_pos").cast("bigint").alias("_pos"),
    )
    if simulated is None:
        return history
    others = simulated.select(
        *COLUMNS[:-1],
        named_record(simulated).alias("record_hash"),
        F.lit("simulated").alias("source"),
        F.lit(1).alias("_source"),
        F.lit("").alias("_key"),
        F.col("position").cast("bigint").alias("_pos"),
    )
    return history.unionByName(others)


REVIEW_ORDER = ("_source", "_key", "_pos", "clause_id", "record_hash")


def disposition(action: Column, agent_status: Column, model_severity: Column) -> Column:
    """``confirmation``, ``override`` or null (nothing follows from the review)."""
    act = F.lower(F.coalesce(action, F.lit("")))
    return F.when(act.isin(*fixed.CONFIRMING_ACTIONS), "confirmation").when(
        act.isin(*fixed.OVERRIDING_ACTIONS)
        & (F.coalesce(agent_status, F.lit("")) != "escalated")
        & model_severity.isin(*fixed.OVERRIDABLE_SEVERITIES),
        "override",
    )


def overridden_field(findings: Column) -> Column:
    """The standard the reviewer disagreed with: the worst finding that cites one, first on ties."""
    citing = F.filter(findings, lambda f: F.coalesce(f["standard_reference"], F.lit("")) != "")
    ranked = F.transform(
        citing,
        lambda f, i: F.struct(
            severity.rank(f["severity"]).alias("rank"), (-i).alias("order"), f["standard_reference"].alias("ref")
        ),
    )
    return F.coalesce(
        F.concat(F.lit("risk.findings."), F.array_max(ranked)["ref"]), F.lit("risk.overall_severity")
    )


def reconcile(reviews: DataFrame, assessments: DataFrame) -> DataFrame:
    """Reviews that meet an assessment, with what follows from each; ``record_hash`` is the assessment's.

    ``assessments``: ``clause_id, findings, overall_severity, risk_status`` and ``record_hash``, one row a
    record.  Reviews of records without an assessment drop out; one that names no record meets all of its id.
    """
    sides = assessments.select(
        "clause_id",
        named_record(assessments).alias("_assessed"),
        "findings",
        F.col("overall_severity").alias("model_value"),
        F.col("risk_status").alias("_status"),
    )
    return (
        reviews.withColumn("record_hash", named_record(reviews))
        .join(sides, "clause_id")
        .where(F.coalesce(F.col("record_hash") == F.col("_assessed"), F.lit(True)))
        .withColumn("record_hash", F.coalesce("_assessed", "record_hash"))
        .drop("_assessed")
        .withColumn("outcome", disposition(F.col("action"), F.col("_status"), F.col("model_value")))
        .withColumn("inferred_field", overridden_field(F.col("findings")))
    )


OVERRIDE = ("clause_id", "reviewer", "date", "field", "human_value", "source")


def overrides(
    reconciled: DataFrame, agent: str = "risk_flagger", order: Sequence[str] = REVIEW_ORDER, recorded: DataFrame | None = None
) -> DataFrame:
    """Override rows, numbered in review order (no one-task window).

    With ``recorded`` (earlier override rows) only the new ones, numbered after the highest recorded
    number: an id once given never moves.  A recorded row without a hash stands for all records of its id.
    """
    chosen = (
        reconciled.withColumn("record_hash", named_record(reconciled))
        .where(F.col("outcome") == "override")
        .withColumn("field", F.coalesce(F.nullif("field", F.lit("")), F.col("inferred_field")))
        .withColumn("human_value", F.coalesce("human_value", F.lit("accepted")))
    )
    first = 0
    if recorded is not None:
        first = recorded.agg(F.max("seq")).first()[0] or 0
        identity = F.struct(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in OVERRIDE])
        known = recorded.select(identity.alias("_known"), named_record(recorded).alias("_hash"))
        same = (F.col("_identity") == F.col("_known")) & F.coalesce(F.col("record_hash") == F.col("_hash"), F.lit(True))
        chosen = chosen.withColumn("_identity", identity).join(known, same, "left_anti").drop("_identity")
    # Human decisions: few next to the records, and numbering reads them more than once.
    numbered = number_rows(cut_lineage(chosen), order, "seq").withColumn("seq", F.col("seq") + first)
    return numbered.select(
        override_id("OVR", F.col("clause_id"), F.col("seq")).alias("override_id"),
        "clause_id",
        F.lit(agent).alias("agent"),
        "reviewer",
        "date",
        "field",
        "model_value",
        "human_value",
        "rationale",
        "source",
        "findings",
        "seq",
        "record_hash",
    )


def override_id(prefix: str, clause_id: Column, seq: Column) -> Column:
    """``<prefix>-<record>-<nn>``: the running number with at least two digits."""
    return F.concat(F.lit(f"{prefix}-"), clause_id, F.lit("-"), F.format_string("%02d", seq))


def escalation_ids(queue: DataFrame, order: Sequence[str], recorded: DataFrame | None = None) -> DataFrame:
    """Escalations, numbered after the highest number of the ``recorded`` ones."""
    first = 0 if recorded is None else recorded.agg(F.max("seq")).first()[0] or 0
    numbered = number_rows(queue, order, "seq").withColumn("seq", F.col("seq") + first)
    return numbered.withColumn("escalation_id", override_id("ESC", F.col("clause_id"), F.col("seq"))).withColumn(
        "status", F.lit("OPEN")
    )


def applied_overrides(found: DataFrame, *by: str, name: str = "_applied") -> DataFrame:
    """Per key a struct: the last override, by ``seq``, and how many there are."""
    last = F.max(F.struct("seq", "override_id")).alias("last")
    return found.groupBy(*by).agg(last, F.count(F.lit(1)).alias("n")).select(*by, F.struct("last", "n").alias(name))


def with_overrides(assessed: DataFrame, found: DataFrame) -> DataFrame:
    """The effective view: an overridden record reads as low severity, resolved by a person.

    Overrides are those of the record, by id and hash, and those of its id that name no record.  Where
    ``assessed`` does not tell records of an id apart, all overrides of the id count.
    """
    hit = F.col("overridden_by").isNotNull()
    if {"record_hash", "_lineage", "lineage"}.isdisjoint(assessed.columns):
        joined = assessed.join(applied_overrides(found, "clause_id", name="_own"), "clause_id", "left")
        joined = joined.withColumn("_all", F.lit(None).cast(joined.schema["_own"].dataType))
    else:
        found = found.withColumn("_hash", named_record(found))
        own = applied_overrides(found.where("_hash is not null"), "clause_id", "_hash", name="_own")
        every = applied_overrides(found.where("_hash is null"), "clause_id", name="_all")
        keyed = assessed.withColumn("_hash", named_record(assessed))
        joined = keyed.join(own, ["clause_id", "_hash"], "left").join(every, "clause_id", "left").drop("_hash")
    count = F.coalesce("_own.n", F.lit(0)) + F.coalesce("_all.n", F.lit(0))
    return (
        joined.withColumn("overridden_by", F.greatest("_own.last", "_all.last")["override_id"])
        .withColumn("override_count", F.when(hit, count))
        .drop("_own", "_all")
        .withColumn("overall_severity", F.when(hit, "low").otherwise(F.col("overall_severity")))
        .withColumn("status", F.when(hit, "overridden").otherwise(F.col("status")))
        .withColumn("review_status", F.when(hit, "resolved_by_override").otherwise(F.col("review_status")))
    )


def _payload(findings: Column, overall: Column, overridden_by: Column | None = None) -> Column:
    parts = [findings.alias("findings"), overall.alias("overall_severity")]
    if overridden_by is not None:
        parts.append(overridden_by.alias("_overridden_by"))
    return F.to_json(F.struct(*parts))


def review_ledger_rows(reconciled: DataFrame, found: DataFrame, run_id: str, timestamp: str) -> DataFrame:
    """New ledger rows for confirmations and overrides; the model's own row is never edited."""
    agreed = reconciled.withColumn("record_hash", named_record(reconciled)).where(F.col("outcome") == "confirmation")
    confirmed = ledger_rows(
        agreed,
        agent="auditor",
        action="human_confirmation",
        clause_id=F.col("clause_id"),
        decided_by=F.lit("human"),
        lineage=record_lineage(F.col("record_hash")),
        status=F.lit("accepted"),
        run_id=run_id,
        timestamp=timestamp,
        model_output=_payload(F.col("findings"), F.col("model_value")),
        human_decision=F.to_json(
            F.struct("reviewer", F.lit("confirmed").alias("action"), "date", "rationale", "source")
        ),
        effective_value=_payload(F.col("findings"), F.col("model_value")),
        detail=F.concat("reviewer", F.lit(" agreed with the agent's assessment.")),
    )
    replaced = ledger_rows(
        found,
        agent="auditor",
        action="human_override",
        clause_id=F.col("clause_id"),
        decided_by=F.lit("human"),
        lineage=record_lineage(F.col("record_hash")),
        status=F.lit("overridden"),
        run_id=run_id,
        timestamp=timestamp,
        model_output=_payload(F.col("findings"), F.col("model_value")),
        human_decision=F.to_json(
            F.struct(
                "override_id", "clause_id", "agent", "reviewer", "date", "field", "model_value", "human_value",
                "rationale", "source",
            )
        ),
        effective_value=_payload(F.col("findings"), F.lit("low"), F.col("override_id")),
        detail=F.format_string(
            "%s overrode %s: %s -> %s. This changes this record only; the rule is unchanged.",
            "reviewer", "field", "model_value", "human_value",
        ),
    )
    return confirmed.unionByName(replaced)


