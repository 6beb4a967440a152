"""Policy rules as native column expressions, and the registry users extend.

A rule may read one value from the lower-cased text (``seen``) and decides from it, or from the text
itself, whether it fires and with which finding.  Rules run only for rows of their
own category, and every value is read once per row, so a row pays for one category's patterns.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping
from dataclasses import dataclass
from functools import reduce
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attestra import fixed_values as fixed
from attestra import schemas
from attestra.functions import numbers, severity
from attestra.functions.binding import evaluated_once
from attestra.functions.text import fill
from attestra.operators.policy import BASELINE, Policy
from attestra.session import reachable


Fired = tuple[Column, Column] | None


@dataclass(frozen=True)
class Rule:
    """``fires(text, seen, policy)`` gives (condition, finding), or None when the policy sets no limit.

    ``seen(text)`` is what the rule reads from the text; without it ``fires`` gets None.
    """

    reference: str
    fires: Callable[[Column, Column | None, Policy], Fired]
    seen: Callable[[Column], Column] | None = None
    # Reads what ``seen`` leaves null, from the lower-cased texts of its category only: Arrow batches of texts in,
    # numbers or null out.
    read: Callable[[pd.Series], pd.Series] | None = None


RuleSet = Mapping[str, "list[Rule]"]


def finding(
    reference: str,
    policy: Policy,
    seen: Column | None = None,
    limit: Column | None = None,
) -> Column:
    """The finding struct for ``reference`` with its published texts filled in."""
    risk, default_severity, observed, expected, alternative = fixed.FINDING_TEXTS[reference]
    standard = policy.get(reference)
    slots = {k: v for k, v in (("seen", seen), ("limit", limit)) if v is not None}
    if alternative.startswith("*"):
        own = standard.acceptable_language_example if standard else None
        alternative = own or alternative[1:]
    level = (standard.severity_if_breached if standard else None) or default_severity
    return F.struct(
        fill(risk, **slots).alias("risk"),
        F.lit(level).alias("severity"),
        F.lit(1.0).alias("confidence"),
        F.lit(reference).alias("standard_reference"),
        fill(observed, **slots).alias("observed"),
        fill(expected, **slots).alias("expected"),
        fill(alternative, **slots).alias("suggested_alternative"),
        F.array().cast("array<string>").alias("precedent_clause_ids"),
    ).cast(schemas.FINDING)


def _matches(text: Column, pattern: str) -> Column:
    return text.rlike(numbers.unicode_classes(pattern))


def _any(text: Column, patterns: tuple[str, ...]) -> Column:
    return reduce(lambda a, b: a | b, [_matches(text, p) for p in patterns])


def _forbidden(policy: Policy, reference: str) -> bool:
    """True when the policy says the practice is not permitted (a missing row permits it)."""
    standard = policy.get(reference)
    return standard is not None and not (True if standard.value is None else standard.value)


def _text_rule(reference: str, fires: Callable[[Column], Column], active: Callable[[Policy], bool]) -> Rule:
    """A rule about wording alone."""
    return Rule(
        reference,
        lambda text, _seen, policy: (fires(text), finding(reference, policy)) if active(policy) else None,
    )


def _prohibition(reference: str, fires: Callable[[Column], Column]) -> Rule:
    return _text_rule(reference, fires, lambda policy: _forbidden(policy, reference))


def _requirement(reference: str, fires: Callable[[Column], Column]) -> Rule:
    return _text_rule(reference, fires, lambda policy: bool(policy.value(reference)))


def _maximum(reference: str, seen: Callable[[Column], Column], show: Callable[[Column], Column]) -> Rule:
    """A measured amount above the policy's maximum; no policy value means no limit."""

    def fires(_text: Column, value: Column, policy: Policy) -> Fired:
        bound = policy.value(reference)
        if bound is None:
            return None
        limit = F.lit(float(bound))
        return value > limit, finding(reference, policy, show(value), show(limit))

    return Rule(reference, fires, seen)


def _whole(reference: str, seen: Callable[[Column], Column], breach: Callable[[Column, Column], Column]) -> Rule:
    """Day and year counts: compared as whole numbers, the policy value shown as written."""

    def fires(_text: Column, value: Column, policy: Policy) -> Fired:
        bound = policy.value(reference)
        if bound is None:
            return None
        return breach(value, F.lit(int(bound))), finding(reference, policy, value, F.lit(f"{bound}"))

    return Rule(reference, fires, seen)


def _first_trigger() -> Rule:
    """The first trigger phrase of the policy row that stands in the text."""
    reference = "scope_of_work.open_ended_scope_language_permitted"

    def fires(text: Column, _seen: Column | None, policy: Policy) -> Fired:
        phrases = policy.get(reference).trigger_phrases if _forbidden(policy, reference) else ()
        if not phrases:
            return None
        first = F.coalesce(*[F.when(text.contains(p), F.lit(p)) for p in phrases])
        return first.isNotNull(), finding(reference, policy, first)

    return Rule(reference, fires)


def _either_amount(first: str, second: str) -> Callable[[Column], Column]:
    return lambda text: F.coalesce(numbers.amount(text, first), numbers.amount(text, second))


RULES: dict[str, list[Rule]] = {
    "indemnification": [
        # Applies whatever the policy row says, and even without one.
        _text_rule(
            "indemnification.must_be_limited_to_own_negligence",
            lambda text: _any(text, fixed.OWNER_NEGLIGENCE) & ~_any(text, fixed.CARVE_OUTS),
            lambda _policy: True,
        ),
        _prohibition(
            "indemnification.duty_to_defend_permitted",
            lambda text: text.contains(fixed.INDEMNITY_STEM) & _matches(text, fixed.DEFEND_WORD),
        ),
        _prohibition(
            "indemnification.fullest_extent_permitted_by_law_permitted",
            lambda text: text.contains(fixed.FULLEST_EXTENT),
        ),
    ],
    "liability": [
        _maximum("liability.max_cap_multiple_of_fees", numbers.liability_multiple, numbers.general_number),
    ],
    "payment_terms": [
        _whole("payment_terms.max_days_to_pay", numbers.first_days, lambda seen, bound: seen > bound),
        _maximum(
            "payment_terms.max_retainage_percent",
            _either_amount(fixed.RETAINAGE_UP_TO, fixed.RETAINAGE_WITHHOLD),
            numbers.general_number,
        ),
        _prohibition(
            "payment_terms.discretionary_withholding_permitted",
            lambda text: _matches(text, fixed.DISCRETIONARY_WITHHOLDING),
        ),
        _requirement("payment_terms.late_interest_required", lambda text: ~text.contains(fixed.INTEREST_WORD)),
    ],
    "termination": [
        _whole(
            "termination.min_notice_days_for_convenience",
            lambda text: numbers.nearest_days(text, fixed.CONVENIENCE_WORD),
            lambda seen, bound: seen < bound,
        ),
        _requirement(
            "termination.demobilisation_costs_recoverable",
            lambda text: text.contains(fixed.CONVENIENCE_WORD)
            & _matches(text, fixed.COSTS_EXCLUDED)
            & ~_matches(text, fixed.COSTS_RECOVERABLE),
        ),
    ],
    "insurance": [
        _maximum(
            "insurance.max_professional_liability_per_claim_usd",
            _either_amount(fixed.PER_CLAIM_FIRST, fixed.PER_CLAIM_SECOND),
            numbers.whole_dollars,
        ),
        _whole("insurance.max_tail_years_after_completion", numbers.tail_years, lambda seen, bound: seen > bound),
    ],
    "scope_of_work": [_first_trigger()],
}


def extended_rules(category: str, rule: Rule, policy: Policy = BASELINE, base: RuleSet = RULES) -> dict[str, list[Rule]]:
    """A rule set with one more rule; the rule's reference must exist in the policy."""
    if policy.get(rule.reference) is None:
        raise ValueError(f"policy {policy.version} has no standard {rule.reference!r}")
    if category not in fixed.REVIEW_CATEGORIES:
        raise ValueError(f"unknown review category {category!r}")
    out = {c: list(rules) for c, rules in base.items()}
    out.setdefault(category, []).append(rule)
    return out


def affected_categories(changed: set[str], rules: RuleSet = RULES) -> set[str]:
    """The review categories whose records a change of these standards can touch."""
    return {category for category, entries in rules.items() if any(r.reference in changed for r in entries)}


def sql_rule(reference: str, value: str, breach: str, shown: str = "CAST(value AS STRING)") -> Rule:
    """A rule in SQL: ``value`` reads ``text`` (lower-cased), ``breach`` compares ``value`` with ``bound``, the policy's.

    The expressions may call every function the session knows, registered ones too.
    """
    read = f"`_seen_{reference}`"

    def fires(_text: Column, seen: Column, policy: Policy) -> Fired:
        bound = policy.value(reference)
        if bound is None:
            return None
        fired = F.expr(_named(breach, value=read, bound=_literal(bound)))
        return fired, finding(reference, policy, F.expr(_named(shown, value=read)), F.lit(f"{bound}"))

    return Rule(reference, fires, lambda _text: F.expr(_named(value, text="`_lowered`")))


def _named(sql: str, **names: str) -> str:
    """The expression with its variables replaced; quoted text is left alone."""
    word = re.compile(r"'(?:[^'\\]|\\.)*'|\b(" + "|".join(names) + r")\b")
    return word.sub(lambda m: names[m.group(1)] if m.group(1) else m.group(), sql)


def _literal(value: Any) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'" if isinstance(value, str) else str(value)


def _read(category: Column, lowered: Column, rules: RuleSet) -> dict[str, Column]:
    """What each rule reads, only for rows of its category."""
    return {
        f"_seen_{rule.reference}": F.when(category == name, rule.seen(lowered) if rule.seen else F.lit(None).cast("double"))
        for name, entries in rules.items()
        for rule in entries
        if rule.seen is not None or rule.read is not None
    }


def _read_on(category: Column, lowered: Column, rules: RuleSet) -> dict[str, Column]:
    """The values that the columns left open, read in Arrow batches; other rows pass as nulls."""
    out = {}
    for name, entries in rules.items():
        for rule in entries:
            if rule.read is not None:
                seen = F.col(f"`_seen_{rule.reference}`")
                asked = F.when((category == name) & seen.isNull(), lowered)
                out[f"_seen_{rule.reference}"] = F.coalesce(seen.cast("double"), F.pandas_udf(_on_texts(rule.read), "double")(asked))
    return out


def _on_texts(read: Callable[[pd.Series], pd.Series]) -> Callable[[pd.Series], pd.Series]:
    def values(texts: pd.Series) -> pd.Series:
        found = pd.Series([None] * len(texts), index=texts.index, dtype=object)
        given = texts[texts.notna()]
        if len(given):
            found.loc[given.index] = read(given).astype(object)
        return found.where(found.notna(), None)

    return values


def _fired(category: Column, lowered: Column, policy: Policy, rules: RuleSet) -> Column:
    """All findings of a row as an array, in rule order.  Unknown categories have none."""
    none = F.array().cast(f"array<{schemas.FINDING}>")
    out: Column | None = None
    for name, entries in rules.items():
        parts = []
        for rule in entries:
            seen = None if rule.seen is None and rule.read is None else F.col(f"`_seen_{rule.reference}`")
            fired = rule.fires(lowered, seen, policy)
            if fired is not None:
                # One-element arrays joined up stay in generated code; filtering nulls out of an
                # array would not.
                parts.append(F.when(fired[0], F.array(fired[1])).otherwise(none))
        if parts:
            found = F.concat(*parts)
            out = F.when(category == name, found) if out is None else out.when(category == name, found)
    return none if out is None else out.otherwise(none)


def with_findings(
    rows: DataFrame,
    policy: Policy = BASELINE,
    category: str = "review_category",
    text: str = "clause_text",
    rules: RuleSet = RULES,
    output: str = "findings",
) -> DataFrame:
    """Add the findings array.  A map-only step: nothing is shuffled.

    The lower-cased text and the values read from it are columns of their own, so no pattern runs
    twice on a row; later filters read the result instead of running the rules again.
    """
    lowered = F.col("_lowered")
    seen = _read(F.col(category), lowered, rules)
    further = _read_on(F.col(category), lowered, rules)
    if further:
        reachable(rows.sparkSession)
    return evaluated_once(
        rows.withColumn("_lowered", F.lower(F.coalesce(F.col(text), F.lit(""))))
        .withColumns(seen)
        .withColumns(further)
        .withColumn(output, _fired(F.col(category), lowered, policy, rules))
        .drop("_lowered", *seen)
    )


def with_severity(rows: DataFrame, findings: str = "findings") -> DataFrame:
    return rows.withColumn("overall_severity", severity.worst(F.col(findings)))


def exploded(rows: DataFrame, *keys: str) -> DataFrame:
    """One row per finding."""
    return rows.select(*keys, F.posexplode("findings").alias("pos", "f")).select(*keys, "pos", "f.*")


def findings_by_standard(rows: DataFrame) -> DataFrame:
    return (
        exploded(rows)
        .groupBy("standard_reference", "severity")
        .agg(F.count(F.lit(1)).alias("findings"))
    )


def severity_counts(rows: DataFrame) -> DataFrame:
    return rows.groupBy("overall_severity").agg(F.count(F.lit(1)).alias("records"))
