"""Review categories, gates and escalation predicates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attestra import fixed_values as fixed
from attestra.functions import severity
from attestra.functions.binding import bind, evaluated_once
from attestra.functions.text import keyword_evidence

CLASSIFICATION = "struct<category:string,confidence:double,reasoning:string,signals:array<string>>"


def review_category(source_category: Column) -> Column:
    """Review category of a source category; null where the map has none."""
    pairs = [F.lit(x) for item in fixed.SOURCE_CATEGORY_MAP.items() for x in item]
    return F.try_element_at(F.create_map(*pairs), source_category)


def by_source(source_category: Column) -> Column:
    """Classification struct from the source's own label; null where the label does not decide."""
    mapped = review_category(source_category)
    quoted = F.concat(F.lit("'"), source_category, F.lit("'"))
    signals = F.array(F.concat(F.lit("silver.clause_category="), source_category))
    same = mapped == source_category
    known = F.struct(
        mapped.alias("category"),
        F.when(same, fixed.CONFIDENCE_SAME_NAME).otherwise(fixed.CONFIDENCE_RENAMED).alias("confidence"),
        F.concat(
            F.lit("Source system classified this as "),
            quoted,
            F.lit("; "),
            F.when(same, F.lit("the review taxonomy uses the same name.")).otherwise(
                F.concat(F.lit("mapped to review category '"), mapped, F.lit("'."))
            ),
        ).alias("reasoning"),
        signals.alias("signals"),
    ).cast(CLASSIFICATION)
    unmapped = F.struct(
        F.lit("other").alias("category"),
        F.lit(fixed.CONFIDENCE_KNOWN_UNMAPPED).alias("confidence"),
        F.concat(
            F.lit("Source category "),
            quoted,
            F.lit(" is a real clause type with no equivalent in the seven-category review taxonomy."),
        ).alias("reasoning"),
        signals.alias("signals"),
    ).cast(CLASSIFICATION)
    return F.when(mapped.isNotNull(), known).when(
        source_category.isin(*fixed.KNOWN_UNMAPPED), unmapped
    )


def by_keywords(
    lowered: Column, categories: Sequence[tuple[str, Sequence[str]]] = fixed.CATEGORY_KEYWORDS
) -> Column:
    """Classification struct from keyword evidence in the text."""
    return bind(
        keyword_evidence(lowered, categories),
        lambda e: F.struct(
            e["category"].alias("category"),
            e["confidence"].alias("confidence"),
            F.when(
                F.size(e["signals"]) > 0,
                F.concat(
                    F.lit("Matched "),
                    F.size(e["signals"]).cast("string"),
                    F.lit(" "),
                    e["category"],
                    F.lit(" signal(s): "),
                    F.array_join(e["signals"], ", "),
                    F.lit("."),
                ),
            )
            .otherwise(F.lit("No category signals matched; routing to 'other' for human review."))
            .alias("reasoning"),
            e["signals"].alias("signals"),
        ).cast(CLASSIFICATION),
    )


def classify(
    rows: DataFrame,
    source: str = "clause_category",
    text: str = "clause_text",
    prefer_rules: bool = True,
    model: Column | None = None,
    model_decided_by: Column | None = None,
    min_confidence: float = fixed.ESCALATE_BELOW_CONFIDENCE,
) -> DataFrame:
    """Add ``classification``, ``class_decided_by``, ``class_status`` and ``class_reason``.

    The source label decides first; only rows it leaves open take the model's struct (keyword
    evidence unless a column of parsed model output is given; null there means unparseable).
    """
    model = by_keywords(F.lower(F.coalesce(F.col(text), F.lit("")))) if model is None else model
    model_decided_by = F.lit("model") if model_decided_by is None else model_decided_by
    # A known but unmapped label escalates even when the source's labels are not trusted.
    source_col = F.col(source)
    known_unmapped = F.coalesce(source_col.isin(*fixed.KNOWN_UNMAPPED), F.lit(False))
    ruled = F.coalesce(review_category(source_col).isNotNull(), F.lit(False)) & F.lit(prefer_rules)
    by_rule = ruled | known_unmapped
    out = evaluated_once(
        rows.withColumn(
            "classification", F.when(by_rule, by_source(source_col)).otherwise(model.cast(CLASSIFICATION))
        )
    )
    low = F.col("classification.confidence") < min_confidence
    reason = (
        F.when(known_unmapped, "category_outside_review_taxonomy")
        .when(F.col("classification").isNull(), "unparseable_model_output")
        .when(~by_rule & low, "low_confidence_classification")
    )
    return (
        out.withColumn("class_decided_by", F.when(by_rule, F.lit("rule")).otherwise(model_decided_by))
        .withColumn("class_reason", reason)
        .withColumn(
            "class_status", F.when(F.col("class_reason").isNull(), "proposed").otherwise("escalated")
        )
    )


def scope_refusal(
    text: Column, min_chars: int = fixed.MIN_CLAUSE_CHARS, max_chars: int = fixed.MAX_CLAUSE_CHARS
) -> Column:
    """Why a text is not looked at, or null when it is in scope."""
    body = F.coalesce(text, F.lit(""))
    return (
        F.when(~body.rlike(r"(?U)\S"), "empty_clause_text")
        .when(F.length(body) < min_chars, "clause_too_short")
        .when(F.length(body) > max_chars, "clause_too_long")
    )


def category_allowed(category: Column, allowed: Sequence[str] = fixed.REVIEW_CATEGORIES) -> Column:
    return F.coalesce(category.isin(*allowed), F.lit(False))


def risk_bearing(category: Column, bearing: Sequence[str] = fixed.RISK_BEARING_CATEGORIES) -> Column:
    """Only these categories earn the second, costlier pass; all others get rules only."""
    return F.coalesce(category.isin(*bearing), F.lit(False))


def review_required(overall: Column, at: str = fixed.REVIEW_REQUIRED_AT) -> Column:
    return severity.rank(overall) >= fixed.SEVERITY_RANK[at]
