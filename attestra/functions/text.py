"""Section references, keyword evidence, prompt text and model-output clean-up."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from attestra import fixed_values as fixed
from attestra.functions.binding import bind


def section_key(section_ref: Column) -> Column:
    """``Section 8.1 (Amended)`` -> ``8.1``; null where no number is present."""
    stripped = F.regexp_replace(section_ref, "(?U)" + fixed.AMENDMENT_PATTERN, "")
    return F.nullif(F.regexp_extract(stripped, "(?U)" + fixed.SECTION_NUMBER_PATTERN, 1), F.lit(""))


def is_amendment(section_ref: Column) -> Column:
    return F.coalesce(section_ref.rlike("(?U)" + fixed.AMENDMENT_PATTERN), F.lit(False))


def keyword_hits(lowered: Column, keywords: Iterable[str]) -> Column:
    """The keywords found in the text, in list order."""
    return F.array_compact(F.array(*[F.when(lowered.contains(k), F.lit(k)) for k in keywords]))


def keyword_evidence(
    lowered: Column, categories: Sequence[tuple[str, Sequence[str]]] = fixed.CATEGORY_KEYWORDS
) -> Column:
    """Struct ``(category, confidence, signals)``: most distinct hits wins, first listed on ties.

    No hit at all gives ``other``, whose confidence is low enough to be escalated.
    """
    found = F.array(
        *[
            F.struct(
                F.lit(-rank).alias("order"),
                F.lit(category).alias("category"),
                keyword_hits(lowered, words).alias("signals"),
            )
            for rank, (category, words) in enumerate(categories)
        ]
    )
    scored = F.transform(
        found,
        lambda f: F.struct(
            F.size(f["signals"]).alias("n"),
            f["order"].alias("order"),
            f["category"].alias("category"),
            f["signals"].alias("signals"),
        ),
    )
    return bind(
        F.array_max(scored),
        lambda best: F.when(
            best["n"] > 0,
            F.struct(
                best["category"].alias("category"),
                F.round(
                    F.least(
                        F.lit(fixed.KEYWORD_CONFIDENCE_MAX),
                        F.lit(fixed.KEYWORD_CONFIDENCE_BASE)
                        + F.lit(fixed.KEYWORD_CONFIDENCE_STEP) * best["n"],
                    ),
                    2,
                ).alias("confidence"),
                best["signals"].alias("signals"),
            ),
        ).otherwise(
            F.struct(
                F.lit("other").alias("category"),
                F.lit(fixed.KEYWORD_CONFIDENCE_OTHER).alias("confidence"),
                F.array().cast("array<string>").alias("signals"),
            )
        ),
    )


def fill(template: str, **values: Column) -> Column:
    """Put columns into the ``{name}`` slots of a text; other braces stay as they are."""
    parts: list[Column] = []
    rest = template
    while rest:
        found = [(rest.find("{" + name + "}"), name) for name in values]
        found = [f for f in found if f[0] >= 0]
        if not found:
            parts.append(F.lit(rest))
            break
        at, name = min(found)
        if at:
            parts.append(F.lit(rest[:at]))
        parts.append(values[name].cast("string"))
        rest = rest[at + len(name) + 2 :]
    return parts[0] if len(parts) == 1 else F.concat(*parts) if parts else F.lit("")


def render_prompt(template: str, values: Mapping[str, Column]) -> Column:
    return fill(template, **values)


def strip_code_fence(content: Column) -> Column:
    """Model output often arrives inside a code fence; keep what is inside it."""
    return bind(
        F.btrim(content, F.lit(" \t\n\r\x0b\x0c")),
        lambda text: F.when(
            text.startswith("```") & text.rlike(fixed.CODE_FENCE), F.regexp_extract(text, fixed.CODE_FENCE, 1)
        ).otherwise(text),
    )
