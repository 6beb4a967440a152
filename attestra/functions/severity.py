"""Severity order."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from attestra import fixed_values as fixed


def rank(severity: Column, ranks: Mapping[str, int] = fixed.SEVERITY_RANK) -> Column:
    expression = F.when(F.lit(False), F.lit(0))
    for name, value in ranks.items():
        expression = expression.when(severity == name, F.lit(value))
    return expression.otherwise(F.lit(0))


def name(value: Column, ranks: Mapping[str, int] = fixed.SEVERITY_RANK) -> Column:
    names = [n for n, _ in sorted(ranks.items(), key=lambda item: item[1])]
    return F.element_at(F.array(*[F.lit(n) for n in names]), value + 1)


def worst(findings: Column) -> Column:
    """The worst severity in an array of findings; ``none`` for an empty array."""
    top = F.array_max(F.transform(findings, lambda f: rank(f["severity"])))
    return name(F.coalesce(top, F.lit(0)))
