"""Quality rules with adaptive thresholds instead of fixed cutoffs.

Ratios of every text are compared with fences that come from the texts themselves: for each
language and source, a mergeable quantile sketch of each measure gives its quartiles, and a value far
outside them fails.  Sources with few documents use the sketch of their language, and small languages
that of all documents.  The fences, one row a group, are joined back to the measures.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attestra.functions.binding import evaluated_once
from attestra.llm.common import own_columns, prepared, small_side, written
from attestra.llm.encoding import release

SYMBOLS = "#*$%&|<>"
GAPS = " \t\n\v\f\r"
WINDOW = 8
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_stutter_words")


def numbered(words: list[bytes]) -> np.ndarray:
    """Equal words have equal numbers, from 0 without gaps."""
    codes: dict[bytes, int] = {}
    return np.fromiter((codes.setdefault(w, len(codes)) for w in words), np.int64, len(words))


def repeated_words(ids: np.ndarray, window: int = WINDOW) -> int:
    """Words inside windows that occur twice or more, the first occurrence included."""
    size = len(ids)
    if size <= window or int(ids.max()) + 1 == size:
        return 0
    # Windows of doubled length are pairs of windows: their numbers stay exact and small.
    width = 1
    while width < window:
        step = min(width, window - width)
        pairs = ids[: len(ids) - step] * (int(ids.max()) + 1) + ids[step:]
        distinct, ids = np.unique(pairs, return_inverse=True)
        if len(distinct) == len(pairs):
            return 0
        width += step
    twice = np.bincount(ids)[ids] > 1
    if not twice.any():
        return 0
    marks = np.zeros(size + 1, np.int64)
    starts = np.nonzero(twice)[0]
    np.add.at(marks, starts, 1)
    np.add.at(marks, starts + window, -1)
    return int((np.cumsum(marks)[:-1] > 0).sum())


def measures(text: str | None) -> tuple[int, ...]:
    """The values of ``COUNTS``; null has no words.  A word stutters if it equals the word before."""
    if not text:
        return (0,) * len(COUNTS)
    words = text.encode().split()
    word_chars = len(text) - sum(text.count(c) for c in GAPS)
    symbols = sum(text.count(c) for c in SYMBOLS)
    lines = [line for line in text.split("\n") if line.strip(GAPS)]
    ids = numbered(words)
    stutter = int((ids[1:] == ids[:-1]).sum())
    return len(words), word_chars, symbols, len(lines) - len(set(lines)), repeated_words(ids), stutter


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    release()
    for batch in batches:
        rows = [measures(t) for t in batch.column("text").to_pylist()]
        columns = np.array(rows, np.int64).reshape(-1, len(COUNTS)).T
        rest = batch.schema.get_field_index("text")
        kept = [i for i in range(batch.num_columns) if i != rest]
        yield pa.RecordBatch.from_arrays(
            [*[batch.column(i) for i in kept], *[pa.array(np.ascontiguousarray(c)) for c in columns]],
            [*[batch.schema.names[i] for i in kept], *COUNTS],
        )


def _measured(texts: pd.Series) -> pd.DataFrame:
    release()
    return pd.DataFrame([measures(t) for t in texts], columns=list(COUNTS), dtype="int64")


@dataclass(frozen=True)
class Rules:
    """A measure fails beyond its quartile by ``reach`` times the spread between the quartiles.

    ``slack`` is the least distance of a fence from its quartile, so a measure that hardly varies in a
    group (all zero, say) does not fail texts that differ a little.  A group needs ``least_documents``
    for fences of its own.
    """

    reach: float = 3.0
    symbol_slack: float = 0.05  # symbols for each character of words
    duplicate_slack: float = 5.0  # repeated lines for each hundred words
    repeat_slack: float = 0.30  # share of words in repeated windows
    stutter_slack: float = 0.20  # share of words that equal the word before
    length_slack: float = 2.0  # characters of a word, both sides
    least_documents: int = 200
    accuracy: int = 10_000


DEFAULT = Rules()


def _ratios() -> dict[str, Column]:
    words = F.greatest(F.col("n_words"), F.lit(1))
    return {
        "symbols": F.col("n_symbols") / F.greatest(F.col("word_chars"), F.lit(1)),
        "duplicates": 100 * F.col("n_dup_lines") / words,
        "repeats": F.col("n_repeat_words") / words,
        "stutter": F.col("n_stutter_words") / words,
        "length": F.col("word_chars") / words,
    }


def _fences(ratios: DataFrame, keys: list[str], rules: Rules) -> DataFrame:
    slack = {
        "symbols": rules.symbol_slack,
        "duplicates": rules.duplicate_slack,
        "repeats": rules.repeat_slack,
        "stutter": rules.stutter_slack,
        "length": rules.length_slack,
    }
    sketches = [F.percentile_approx(m, [0.25, 0.5, 0.75], rules.accuracy).alias(f"q_{m}") for m in slack]
    grouped = ratios.where(~F.col("base_failed")).groupBy(*keys).agg(F.count("*").alias("n"), *sketches)
    out = []
    for m, s in slack.items():
        low, high = F.col(f"q_{m}")[0], F.col(f"q_{m}")[2]
        away = F.greatest(rules.reach * (high - low), F.lit(s))
        out += [(low - away).alias(f"lo_{m}"), (high + away).alias(f"hi_{m}")]
    fences = F.struct(*out)
    return grouped.where(F.col("n") >= rules.least_documents).select(*keys, fences.alias("fence"))


def _judged(rows: DataFrame, fences: "Fences") -> DataFrame:
    """``rows`` (``lang``, ``source`` and the counts) with the column ``kept``."""
    own = fences.own.select(F.col("lang").alias("_l1"), F.col("source").alias("_s1"), F.col("fence").alias("_f1"))
    tongue = fences.tongue.select(F.col("lang").alias("_l2"), F.col("fence").alias("_f2"))
    joined = rows.join(own, F.col("lang").eqNullSafe(F.col("_l1")) & F.col("source").eqNullSafe(F.col("_s1")), "left")
    joined = joined.join(tongue, F.col("lang").eqNullSafe(F.col("_l2")), "left")
    found = [F.col("_f1"), F.col("_f2")]
    if fences.every is not None:
        found.append(F.struct(*[F.lit(v).alias(k) for k, v in fences.every.items()]))
    joined = joined.withColumn("_fence", F.coalesce(*found))
    inside = F.lit(True)
    for m, ratio in _ratios().items():
        inside = inside & ratio.between(F.col(f"_fence.lo_{m}"), F.col(f"_fence.hi_{m}"))
    kept = ~F.col("base_failed") & F.coalesce(inside, F.lit(True))
    return joined.withColumn("kept", kept).drop("_l1", "_s1", "_f1", "_l2", "_f2", "_fence")


@dataclass(frozen=True)
class Fences:
    """Fences by language and source, by language, and of all documents (None: too few of them)."""

    own: DataFrame
    tongue: DataFrame
    every: dict[str, float] | None


def fences_of(counted: DataFrame, rules: Rules = DEFAULT) -> Fences:
    """Fences from the counts of all documents (``lang``, ``source`` and the counts)."""
    ratios = counted.select("lang", "source", "base_failed", *[c.alias(n) for n, c in _ratios().items()])
    own = written(_fences(ratios, ["lang", "source"], rules), "fences")
    tongue = written(_fences(ratios, ["lang"], rules), "fences")
    whole = _fences(ratios, [], rules).first()  # one row at most
    wide = 256 + F.coalesce(F.octet_length("lang"), F.lit(0))
    return Fences(
        small_side(own, wide + F.coalesce(F.octet_length("source"), F.lit(0))),
        small_side(tongue, wide),
        None if whole is None else whole.fence.asDict(),
    )


def _counted(docs: DataFrame) -> DataFrame:
    """``doc_id, lang, source``, the counts and ``base_failed`` of every row, written."""
    rows = own_columns(docs, "doc_id", "lang", "source", "text")
    schema = "doc_id long, lang string, source string, " + ", ".join(f"{c} long" for c in COUNTS)
    return written(rows.mapInArrow(_measure, schema).withColumn("base_failed", _base_failed()), "measures")


def _base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def judge(docs: DataFrame, rules: Rules = DEFAULT) -> DataFrame:
    """``doc_id, lang, source``, the counts, ``base_failed`` and ``kept`` of every row of ``docs``.

    Base rules: fewer than 20 words, or more than 30 in 100 words in repeated windows.  A text that
    passes them is kept unless one of its ratios lies outside the fence of its language and source.
    Null and empty texts have no words and fail.  Null languages and sources are groups of their own.
    Groups under ``least_documents`` use the fences of their language, then of all documents; with none
    of these, only the base rules hold.  Repeated rows count each; an empty table gives no rows.

    Sketches are merged from partial ones, so a source with most of the rows costs no task more.
    """
    prepared(docs.sparkSession)
    counted = _counted(docs)
    return _judged(counted, fences_of(counted, rules)).select("doc_id", "lang", "source", *COUNTS, "base_failed", "kept")


def keep_good(docs: DataFrame, rules: Rules = DEFAULT) -> DataFrame:
    """The rows of ``docs`` that ``judge`` keeps, with their own columns.

    The measures are taken a second time beside the texts, which are then never shuffled.
    """
    prepared(docs.sparkSession)
    fences = fences_of(_counted(docs), rules)
    measured = F.pandas_udf(_measured, ", ".join(f"{c} long" for c in COUNTS))
    row = F.struct(*[docs[f"`{c}`"].alias(c) for c in docs.columns]).alias("_row")
    rows = docs.select(row, docs["lang"].alias("lang"), docs["source"].alias("source"), measured(docs["text"]).alias("_m"))
    # Else the filter below is pushed under the measures with a second copy of them.
    rows = evaluated_once(rows).select("_row", "lang", "source", "_m.*").withColumn("base_failed", _base_failed())
    return _judged(rows, fences).where("kept").select("_row.*")
