"""What another policy version changes: which records it can touch, and their findings before and after."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from attestra.operators.policy import Policy
from attestra.operators.rules import RULES, RuleSet, affected_categories

RECORD = ("clause_id", "record_hash")


def touched_since(policy: Policy, earlier: Mapping[str, Policy], rules: RuleSet = RULES) -> dict[str, set[str]]:
    """For each earlier version the categories that the changes up to ``policy`` can touch."""
    return {version: affected_categories(old.changed(policy), rules) for version, old in earlier.items()}


def still_holds(policy_version: Column, category: Column, version: str, touched: Mapping[str, set[str]]) -> Column:
    """Whether a decision under an earlier version is what ``version`` would decide.

    It is if it was made under that version, or if no changed standard applies to its category.  Decisions
    under versions that are not known are made again.
    """
    holds = policy_version == version
    for earlier, categories in touched.items():
        free = ~category.isin(*sorted(categories)) if categories else F.lit(True)
        holds = holds | ((policy_version == earlier) & F.coalesce(free, F.lit(False)))
    return F.coalesce(holds, F.lit(False))


def finding_changes(before: DataFrame, after: DataFrame) -> DataFrame:
    """One row per finding of either side: ``added``, ``removed``, ``changed`` or ``same``.

    Both sides: ``clause_id, record_hash, findings``.  Findings of a record are matched by standard, those
    that share one in their order; records of one side only are not compared.
    """

    def side(rows: DataFrame, name: str) -> DataFrame:
        each = rows.select(*RECORD, F.posexplode("findings").alias("pos", "f"))
        nth = F.row_number().over(Window.partitionBy(*RECORD, "f.standard_reference").orderBy("pos"))
        return each.select(*RECORD, F.col("f.standard_reference").alias("standard_reference"), nth.alias("_nth"), F.col("f").alias(name))

    both = before.select(*RECORD).join(after.select(*RECORD), list(RECORD)).distinct()
    old = side(before.join(both, list(RECORD), "left_semi"), "old")
    new = side(after.join(both, list(RECORD), "left_semi"), "new")
    told = ("severity", "observed", "expected")
    same = F.struct(*[F.col(f"old.{c}") for c in told]).eqNullSafe(F.struct(*[F.col(f"new.{c}") for c in told]))
    change = F.when(F.col("old").isNull(), "added").when(F.col("new").isNull(), "removed").when(same, "same").otherwise("changed")
    joined = old.join(new, [*RECORD, "standard_reference", "_nth"], "full_outer")
    sides = [F.col(f"{s}.{c}").alias(f"{c}_{w}") for c in told for s, w in (("old", "before"), ("new", "after"))]
    return joined.select(*RECORD, "standard_reference", change.alias("change"), *sides)
