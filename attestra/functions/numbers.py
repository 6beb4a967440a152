"""Numbers read from contract language, and their text forms."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from attestra import fixed_values as fixed
from attestra.functions.binding import bind


def unicode_classes(pattern: str) -> str:
    r"""``\s``, ``\d``, ``\w`` and ``\b`` for all of Unicode: contracts are full of no-break spaces."""
    return "(?U)" + pattern


def _found(text: Column, pattern: str) -> Column:
    """First match of ``pattern``, empty where nothing matches: no number, and searched for once only."""
    return F.regexp_extract(text, unicode_classes(pattern), 1)


def _group(text: Column, pattern: str, index: int = 1) -> Column:
    """First match of ``pattern``, or null where nothing matches (no group here can match nothing)."""
    return F.nullif(F.regexp_extract(text, unicode_classes(pattern), index), F.lit(""))


def _word_value(word: Column) -> Column:
    """Number word -> number; null for any other word and for null."""
    pairs = ", ".join(f"'{name}', {value}" for name, value in fixed.NUMBER_WORDS.items())
    return F.try_element_at(F.expr(f"map({pairs})"), word)


def first_days(lowered: Column) -> Column:
    """The first ``(N) [calendar|business] day(s)``."""
    return _found(lowered, fixed.DAYS).try_cast("decimal(38,0)")


def nearest_days(lowered: Column, anchor: str, window: int = fixed.NEAREST_WINDOW) -> Column:
    """The day count that starts nearest to the first ``anchor``; ties go to the earlier one.

    Only the ``window`` characters before and after the start of the anchor are read.  One pattern runs as far
    as it can before the anchor and so finds the last count there, one as little as it can behind it; a
    count opens with a bracket and holds no other, so none reaches across the anchor.
    """
    at = F.instr(lowered, anchor)
    begin = F.greatest(F.lit(1), at - window)
    before = F.substring(lowered, begin, at - begin)
    behind = F.substring(lowered, at, F.lit(window))
    counted = fixed.DAYS.replace("(\\d+)", "\\d+")
    last = _group(before, f"(?s)^.*({counted}.*)$")
    skipped = F.regexp_extract(behind, unicode_classes(f"(?s)^(.*?){counted}"), 1)
    first = _group(behind, fixed.DAYS)
    near = F.when(last.isNotNull() & (first.isNull() | (F.length(last) <= F.length(skipped))), _group(last, "^" + fixed.DAYS))
    return F.when(at > 0, near.otherwise(first).try_cast("decimal(38,0)"))


def liability_multiple(lowered: Column) -> Column:
    """The cap as a multiple of total fees, or null where no cap is stated."""
    gated = F.lit(False)
    for phrase in fixed.MULTIPLE_GATES:
        gated = gated | lowered.contains(phrase)
    return F.when(
        gated,
        F.coalesce(
            _found(lowered, fixed.MULTIPLE_DIGITS).try_cast("double"),
            _word_value(_found(lowered, fixed.MULTIPLE_WORD)).cast("double"),
            F.when(lowered.contains(fixed.MULTIPLE_ONE), F.lit(1.0)),
        ),
    )


def amount(lowered: Column, pattern: str) -> Column:
    """A number with thousands separators; null where the pattern does not match."""
    return F.replace(_found(lowered, pattern), F.lit(","), F.lit("")).try_cast("double")


def tail_years(lowered: Column) -> Column:
    """The years after completion, in digits or as a number word."""
    return bind(
        _found(lowered, fixed.TAIL_YEARS),
        lambda token: F.when(token.rlike(unicode_classes(r"^\d+$")), token.try_cast("decimal(38,0)")).otherwise(
            _word_value(token).try_cast("decimal(38,0)")
        ),
    )


def general_number(value: Column) -> Column:
    """Six significant digits, no trailing zeros (the ``%g`` form)."""

    def trimmed(text: Column) -> Column:
        return F.regexp_replace(text, r"\.?0+$", "")

    def show(rounded: Column) -> Column:
        # ``rounded`` has six significant digits; its exponent decides the form.
        mantissa, exponent = F.substring_index(rounded, "e", 1), F.substring_index(rounded, "e", -1)
        plain = rounded.cast("double").cast("decimal(20,10)").cast("string")
        return F.when(exponent.cast("int").between(-4, 5), trimmed(plain)).otherwise(
            F.concat(trimmed(mantissa), F.lit("e"), exponent)
        )

    return bind(F.format_string("%.5e", value), show)


def whole_dollars(value: Column) -> Column:
    return F.format_number(value, 0)
