"""The versioned policy ("firm standards") that rules are checked against."""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass, replace
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from attestra import fixed_values as fixed
from attestra import schemas


@dataclass(frozen=True)
class Standard:
    section: str
    key: str
    value: Any
    severity_if_breached: str | None = None
    rationale: str | None = None
    acceptable_language_example: str | None = None
    trigger_phrases: tuple[str, ...] = ()

    @property
    def reference(self) -> str:
        return f"{self.section}.{self.key}"


@dataclass(frozen=True)
class Policy:
    """One policy version.  A hand-written list of a few dozen rows, so its values become
    literals in the plan instead of a join."""

    version: str
    standards: Mapping[str, Standard]

    def get(self, reference: str) -> Standard | None:
        return self.standards.get(reference)

    def value(self, reference: str, default: Any = None) -> Any:
        standard = self.get(reference)
        return default if standard is None or standard.value is None else standard.value

    def without(self, reference: str) -> Policy:
        return replace(self, standards={k: v for k, v in self.standards.items() if k != reference})

    def with_value(self, reference: str, value: Any) -> Policy:
        changed = replace(self.standards[reference], value=value)
        return replace(self, standards={**self.standards, reference: changed})

    def changed(self, other: Policy) -> set[str]:
        """References whose standard differs in anything that a rule or a finding reads."""
        told = lambda s: None if s is None else replace(s, rationale=None)
        return {r for r in {*self.standards, *other.standards} if told(self.get(r)) != told(other.get(r))}

    @staticmethod
    def of(version: str, standards: list[Standard]) -> Policy:
        return Policy(version, {s.reference: s for s in standards})

    @staticmethod
    def from_rows(rows: DataFrame, version: str | None = None) -> Policy:
        """Read one version of a policy table (``version=None``: its only version)."""
        chosen = rows if version is None else rows.where(F.col("version") == version)
        found = chosen.orderBy("position").collect()
        return Policy.of(
            found[0]["version"],
            [
                Standard(
                    r["section"],
                    r["key"],
                    None if r["value"] is None else json.loads(r["value"]),
                    r["severity_if_breached"],
                    r["rationale"],
                    r["acceptable_language_example"],
                    tuple(r["trigger_phrases"] or ()),
                )
                for r in found
            ],
        )

    def to_rows(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(
            [
                (
                    self.version,
                    i,
                    s.section,
                    s.key,
                    json.dumps(s.value),
                    s.severity_if_breached,
                    s.rationale,
                    s.acceptable_language_example,
                    list(s.trigger_phrases) or None,
                )
                for i, s in enumerate(self.standards.values())
            ],
            schemas.POLICY,
        )


BASELINE = Policy.of(
    fixed.BASELINE_POLICY_VERSION,
    [
        Standard(section, key, value, severity, None, example, tuple(triggers or ()))
        for section, key, value, severity, example, triggers in fixed.BASELINE_POLICY
    ],
)
