"""Bronze to the published contract, with human-confirmed aliases only."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attestra import fixed_values as fixed
from attestra import schemas


@dataclass(frozen=True)
class Contract:
    """Which payload fields a Silver table publishes.

    ``unified`` is the one field that sources name differently; ``conditional`` fields exist in
    some versions only, and null there means "this version does not send it".
    """

    stable: Sequence[str]
    unified: str
    conditional: Mapping[str, str]
    order: Sequence[str]

    @property
    def fields(self) -> list[str]:
        return [*self.stable, self.unified, *self.conditional]


CLAUSES = Contract(
    fixed.STABLE_FIELDS,
    fixed.UNIFIED_FIELD,
    {"modified_by": "string", "review_history": schemas.REVIEW_HISTORY},
    fixed.SILVER_ORDER,
)


def alias_map(aliases: DataFrame) -> dict[str, str]:
    """Confirmed aliases as a plain dict: a hand-written list, a few rows by nature."""
    return {r["source_field"]: r["target"] for r in aliases.select("source_field", "target").collect()}


def normalise(
    rows: DataFrame, aliases: Mapping[str, str], contract: Contract = CLAUSES, payload: str = "payload"
) -> DataFrame:
    """Add the contract's columns and ``_unmapped_fields`` to each row; the payload is dropped.

    A payload that carries the unified field's own name wins even when it is null there; else
    the confirmed alias that stands last in the payload.
    """
    targets = [a for a, target in aliases.items() if target == contract.unified]
    wanted = {**{f: "string" for f in contract.stable}, contract.unified: "string", **contract.conditional}
    for a in targets:
        wanted.setdefault(a, "string")
    ddl = ", ".join(f"`{name}` {kind}" for name, kind in wanted.items())
    others = [c for c in rows.columns if c != payload]
    parsed = rows.select(
        *others,
        F.from_json(payload, ddl).alias("_p"),
        F.coalesce(F.json_object_keys(payload), F.array().cast("array<string>")).alias("_keys"),
    )

    aliased: Column = F.lit(None).cast("string")
    if targets:
        last_alias = F.try_element_at(F.filter("_keys", lambda k: k.isin(targets)), F.lit(-1))
        aliased = F.coalesce(*[F.when(last_alias == a, F.col(f"_p.`{a}`")) for a in targets])
    unified = F.when(
        F.array_contains("_keys", contract.unified), F.col(f"_p.`{contract.unified}`")
    ).otherwise(aliased)

    known = [*contract.stable, *contract.conditional, *aliases]
    unmapped = F.array_sort(F.array_except("_keys", F.array(*[F.lit(k) for k in known])))
    return parsed.select(
        *others,
        *[
            (unified if f == contract.unified else F.col(f"_p.`{f}`")).alias(f)
            for f in contract.order
        ],
        unmapped.alias("_unmapped_fields"),
        F.size(F.filter("_keys", lambda k: k.isin(targets))).alias("_alias_hits")
        if targets
        else F.lit(0).alias("_alias_hits"),
    )


def to_silver(bronze: DataFrame, aliases: Mapping[str, str]) -> DataFrame:
    """Deduplicated Bronze envelopes to Silver clauses with their lineage."""
    lineage = F.struct(
        *[
            F.col(f"_bronze.{f}")
            for f in ("run_id", "source_file", "source_api_version", "record_index", "record_hash", "ingested_at")
        ]
    )
    rows = bronze.select(lineage.alias("_lineage"), "payload")
    return normalise(rows, aliases).select(*fixed.SILVER_ORDER, "_unmapped_fields", "_lineage")


def null_counts(silver: DataFrame, fields: Sequence[str]) -> DataFrame:
    """``(field, null_count)`` for every contract field, in one pass."""
    counts = silver.agg(*[F.count_if(F.col(f).isNull()).alias(f) for f in fields])
    return counts.unpivot([], list(fields), "field", "null_count")


def key_collisions(silver: DataFrame, key: str = "clause_id") -> DataFrame:
    """Keys under which more than one distinct record arrived; all rows are kept."""
    return silver.groupBy(key).agg(F.count(F.lit(1)).alias("records")).where(F.col("records") > 1)


def issues(silver: DataFrame, key: str = "clause_id", unified: str = fixed.UNIFIED_FIELD) -> DataFrame:
    """One row per record that needs attention: unmapped fields, or no unified value."""
    flags = F.array_compact(
        F.array(
            F.when(F.size("_unmapped_fields") > 0, F.lit("unmapped_fields")),
            F.when(F.col(unified).isNull(), F.lit(f"missing_{unified}")),
        )
    )
    found = silver.select(F.col(key), F.explode_outer(flags).alias("issue"), "_unmapped_fields")
    return found.where(F.col("issue").isNotNull())


def normalisation_report(
    bronze_rows: DataFrame, silver: DataFrame, key: str = "clause_id", unified: str = fixed.UNIFIED_FIELD
) -> DataFrame:
    """One row of totals; the lists behind them are ``issues`` and ``key_collisions``."""
    read = bronze_rows.agg(F.count(F.lit(1)).alias("bronze_records_read"))
    by_key = silver.groupBy(key).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.size("_unmapped_fields") > 0).alias("unmapped"),
        F.count_if(F.col(unified).isNull()).alias("missing"),
    )
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint")
    kept = by_key.agg(
        total("n").alias("silver_records"),
        total("unmapped").alias("records_with_unmapped_fields"),
        total("missing").alias(f"records_without_{unified}"),
        F.count_if(F.col("n") > 1).alias("key_collisions"),
    )
    # Two one-row tables side by side, joined on a constant.
    one = lambda df: df.withColumn("_one", F.lit(1))
    return (
        one(read)
        .join(one(kept), "_one")
        .drop("_one")
        .withColumn("duplicates_dropped", F.col("bronze_records_read") - F.col("silver_records"))
    )


def lineage_orphans(silver: DataFrame, bronze: DataFrame, key: str = "record_hash") -> DataFrame:
    """Silver rows whose record hash has no Bronze record."""
    return silver.join(bronze.select(key), key, "left_anti")


def silver_versions(silver: DataFrame) -> DataFrame:
    """Distinct (api version, run) pairs that fed Silver, with their record counts."""
    return silver.groupBy("_lineage.source_api_version", "_lineage.run_id").agg(
        F.count(F.lit(1)).alias("records")
    )
