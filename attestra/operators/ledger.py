"""The append-only decision ledger: building rows, reading state back from it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attestra import schemas
from attestra.functions.cost import no_usage

# Where ledger rows are stored: a check under one policy version reads that version's folders.
PARTITIONS = ("firm_standards_version", "run_id")

# What makes a human decision another one, next to the record, the action and the policy version.
DECISION = ("reviewer", "field", "date", "source", "human_value")


def _column(value: Column | None, kind: str) -> Column:
    return (F.lit(None) if value is None else value).cast(kind)


def ledger_rows(
    rows: DataFrame,
    *,
    agent: str,
    action: str,
    clause_id: Column,
    decided_by: Column,
    status: Column,
    run_id: str,
    timestamp: str,
    model_output: Column | None = None,
    human_decision: Column | None = None,
    effective_value: Column | None = None,
    prompt_version: Column | None = None,
    model_name: Column | None = None,
    firm_standards_version: str | None = None,
    usage: Column | None = None,
    latency_ms: Column | None = None,
    trace_id: Column | None = None,
    span_id: Column | None = None,
    lineage: Column | None = None,
    detail: Column | None = None,
    seq: Column | None = None,
) -> DataFrame:
    """Project rows into the ledger schema; payloads are JSON texts side by side."""
    record = F.lit(None) if lineage is None else lineage["record_hash"]
    return rows.select(
        F.lit(timestamp).alias("timestamp"),
        F.lit(agent).alias("agent"),
        clause_id.alias("clause_id"),
        F.lit(action).alias("action"),
        _column(model_output, "string").alias("model_output"),
        _column(human_decision, "string").alias("human_decision"),
        _column(effective_value, "string").alias("effective_value"),
        decided_by.alias("decided_by"),
        status.alias("status"),
        F.lit(run_id).alias("run_id"),
        _column(trace_id, "string").alias("trace_id"),
        _column(span_id, "string").alias("span_id"),
        _column(prompt_version, "string").alias("prompt_version"),
        _column(model_name, "string").alias("model_name"),
        F.lit(None).cast("string").alias("rubric_version"),
        F.lit(firm_standards_version).cast("string").alias("firm_standards_version"),
        (no_usage() if usage is None else usage).cast(schemas.USAGE).alias("usage"),
        _column(latency_ms, "double").alias("latency_ms"),
        _column(lineage, schemas.LINEAGE).alias("lineage"),
        _column(detail, "string").alias("detail"),
        _column(seq, "bigint").alias("seq"),
        idempotency_key(clause_id, record, F.lit(action), _column(prompt_version, "string"), F.lit(firm_standards_version)).alias(
            "idempotency_key"
        ),
    )


def idempotency_key(clause_id: Column, record: Column, action: Column, prompt_version: Column, policy_version: Column) -> Column:
    """The identity of a decision: the same record under the same prompt and policy is the same work.

    A decision without a prompt (by rule or evidence) does not depend on one.
    """
    parts = [F.coalesce(c.cast("string"), F.lit("")) for c in (clause_id, record, action, prompt_version, policy_version)]
    return F.sha2(F.to_json(F.array(*parts)), 256)


def record_hash() -> Column:
    """The hash of the record a ledger row is about; empty where the row carries no lineage."""
    return F.coalesce("lineage.record_hash", F.lit(""))


def record_lineage(record: Column) -> Column:
    """A lineage that says only which record a row is about; null for all records of its id."""
    return F.when(record.isNotNull(), F.from_json(F.to_json(F.struct(record.alias("record_hash"))), schemas.LINEAGE))


def _identified(ledger: DataFrame) -> DataFrame:
    parts = [F.coalesce(F.get_json_object("human_decision", f"$.{n}"), F.lit("")) for n in DECISION]
    versions = [F.coalesce(c, F.lit("")) for c in ("firm_standards_version", "prompt_version")]
    return ledger.withColumn("_identity", F.struct("clause_id", "action", *versions, *parts)).withColumn("_hash", record_hash())


def not_yet_recorded(arriving: DataFrame, ledger: DataFrame) -> DataFrame:
    """Rows the ledger does not hold yet: another record, action, prompt or policy version, or for human decisions
    another reviewer, field, date, source or value.  A recorded human decision without a record stands for all of its id."""
    every = (F.col("_hash") == "") & F.col("human_decision").isNotNull()
    known = _identified(ledger).select(F.col("_identity").alias("_known"), F.col("_hash").alias("_record"), every.alias("_every"))
    same = (F.col("_identity") == F.col("_known")) & ((F.col("_hash") == F.col("_record")) | F.col("_every"))
    return _identified(arriving).join(known, same, "left_anti").select(*arriving.columns)


def latest(ledger: DataFrame, keys: Sequence[str] = ("clause_id", "action"), order: Sequence[str] = ("seq",)) -> DataFrame:
    """The last row per key: a partial aggregate per task, so a busy key is no hot spot."""
    rest = [c for c in ledger.columns if c not in keys]
    return (
        ledger.groupBy(*keys)
        .agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("row"))
        .select(*keys, "row.*")
    )


def skip_done(rows: DataFrame, done: DataFrame, *keys: str) -> DataFrame:
    on = list(keys) or ["clause_id"]
    return rows.join(done.select(*on), on, "left_anti")


def decided_under(ledger: DataFrame, order: Sequence[str] = ("timestamp", "seq")) -> DataFrame:
    """Per record with an assessment: its category and the policy and prompts of its last decisions."""
    about = F.struct("firm_standards_version", "prompt_version", F.get_json_object("effective_value", "$.category").alias("category"))
    position = F.struct(*order)

    def last(action: str) -> Column:
        mine = F.col("action") == action
        return F.max_by(F.when(mine, about), F.when(mine, position))

    found = (
        ledger.where(F.col("action").isin("classify_clause", "assess_risk"))
        .groupBy("clause_id", record_hash().alias("record_hash"))
        .agg(last("classify_clause").alias("c"), last("assess_risk").alias("a"))
    )
    return found.where(F.col("a").isNotNull()).select(
        "clause_id",
        "record_hash",
        F.col("c.category").alias("category"),
        F.col("a.firm_standards_version").alias("policy_version"),
        F.col("c.prompt_version").alias("classifier_prompt"),
        F.col("a.prompt_version").alias("assessor_prompt"),
    )


def completed(ledger: DataFrame) -> DataFrame:
    """Records with an assessment in the ledger: the checkpoint, derived instead of stored."""
    assessed = ledger.where(F.col("action") == "assess_risk")
    return assessed.select("clause_id", record_hash().alias("record_hash")).distinct()


def rehydrate(ledger: DataFrame, order: Sequence[str] = ("seq",)) -> DataFrame:
    """Per record its last classification and assessment, ready for the register.

    A record is its id and its hash.  One aggregation does both actions.  An escalated classification stays escalated.
    """
    fields = F.struct("effective_value", "decided_by", "status")
    position = F.struct(*order)

    def last(action: str) -> Column:
        mine = F.col("action") == action
        return F.max_by(F.when(mine, fields), F.when(mine, position))

    found = (
        ledger.where(F.col("action").isin("classify_clause", "assess_risk"))
        .groupBy("clause_id", record_hash().alias("record_hash"))
        .agg(last("classify_clause").alias("c"), last("assess_risk").alias("a"))
    )
    category = F.get_json_object("c.effective_value", "$.category")
    assessed = F.from_json(
        "a.effective_value", f"findings array<{schemas.FINDING}>, overall_severity string, confidence double"
    )
    return found.select(
        "clause_id",
        "record_hash",
        category.alias("review_category"),
        F.when(category.isNotNull(), F.get_json_object("c.effective_value", "$.confidence").cast("double")).alias(
            "classification_confidence"
        ),
        F.when(category.isNotNull(), F.col("c.decided_by")).alias("classification_decided_by"),
        F.coalesce(assessed["findings"], F.array().cast(f"array<{schemas.FINDING}>")).alias("findings"),
        F.coalesce(assessed["overall_severity"], F.lit("none")).alias("overall_severity"),
        F.when(F.col("c.status") == "escalated", "escalated")
        .otherwise(F.coalesce("a.status", "c.status"))
        .alias("status"),
    )


def counts(ledger: DataFrame, *by: str) -> DataFrame:
    return ledger.groupBy(*by).agg(F.count(F.lit(1)).alias("records"))
