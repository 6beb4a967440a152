"""Secrets: credentials by pattern, and strings that look drawn at random from the alphabet of an encoding.

Base patterns find assignments, access keys and runs of hexadecimal digits in whole texts.  Every other
run of 16 or more encoding characters is a candidate.  Its encoding is the smallest alphabet that holds
it, and three tests ask whether its symbols could be independent and uniform there:

* chi-squared of the symbol counts,
* runs: how often the string crosses the middle of the alphabet,
* serial correlation of neighbouring symbols,

each with its exact mean and variance for that length and alphabet.  Fisher's sum of the three gives one
p-value, kept as a level (quarters of a bit, 0 is the most random).

Ordinary text has levels too, and the shorter a string the less the tests tell them apart.  So every text
also gives decoys: its letters and digits, cut into pieces of each length class and written in each alphabet.  In a
stratum (alphabet and length class) the share of decoys at a level or below is the chance that ordinary text
looks that random; Benjamini and Hochberg's rule over the distinct candidates of the stratum sets the highest level
that keeps the rate of false discoveries within ``rate``.  Short classes need more evidence, long ones less.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from attestra.llm.common import own_columns, prepared, written
from attestra.llm.encoding import release

# Fixed patterns; a match that fails its length is dropped and not searched again.
ASSIGN = re.compile(r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
KINDS = ("assign", "access", "hex", "random")
KEYWORDS = (b"passw", b"secret", b"token", b"key")

# A run of one alphabet of 64 symbols, else of the other, with its padding.
CANDIDATE = re.compile(r"((?<![A-Za-z0-9+/])[A-Za-z0-9+/]{16,}+(?![_-])|[A-Za-z0-9_-]{16,}+)={0,2}")

DIGITS, UPPER, LOWER = "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Alphabets by size, each in the order of its symbols' values; all sizes are even.
ALPHABETS = (
    DIGITS, DIGITS + "abcdef", DIGITS + "ABCDEF", LOWER, UPPER + "234567", DIGITS + LOWER, DIGITS + UPPER,
    DIGITS + UPPER + LOWER, UPPER + LOWER + DIGITS + "+/", UPPER + LOWER + DIGITS + "-_",
)
SIZES = tuple(sorted({len(a) for a in ALPHABETS}))
LENGTHS = (16, 20, 24, 32, 48, 64, 96, 128, 256)  # least lengths of the length classes
TOP = 255  # the level of everything that is not random at all
CELLS = 1 << 20  # symbols that are tested at once
STEPS = 256  # of a standard deviation


def _table() -> np.ndarray:
    """``-ln p`` of a two-sided deviation of ``k / STEPS``."""
    steps = np.arange(30 * STEPS)
    return np.array([-math.log(max(math.erfc(k / STEPS / math.sqrt(2)), 1e-300)) for k in steps])


SURPRISE = _table()


def _held(symbols: tuple[str, ...] | str) -> np.ndarray:
    out = np.zeros(256, np.uint8)
    out[np.frombuffer(symbols.encode(), np.uint8)] = np.arange(len(symbols))
    return out


VALUES = [_held(a) for a in ALPHABETS]
SETS = [frozenset(a) for a in ALPHABETS]
ORDINARY = DIGITS + UPPER + LOWER
OTHERS = bytes(range(256)).translate(None, ORDINARY.encode())


def _written(symbols: str) -> np.ndarray:
    """How ordinary text is written in an alphabet: by a character's own value, or that of its other case, or wrapped."""
    out = np.zeros(256, np.uint8)
    for c in ORDINARY:
        known = next((x for x in (c, c.lower(), c.upper()) if x in symbols), None)
        out[ord(c)] = (DIGITS + LOWER).index(c.lower()) % len(symbols) if known is None else symbols.index(known)
    return out


WRITTEN = {len(a): _written(a) for a in reversed(ALPHABETS)}


def levels(symbols: np.ndarray, size: int) -> np.ndarray:
    """The level of each row of symbols (values below ``size``): quarters of a bit of the combined p-value."""
    rows, n = symbols.shape
    counts = np.bincount((np.arange(rows)[:, None] * size + symbols).ravel(), minlength=rows * size).reshape(rows, size)
    square = size / n * (counts * counts).sum(axis=1) - n
    chi = (square - (size - 1)) / math.sqrt(2 * (size - 1) * (n - 1) / n)
    high = symbols >= size // 2
    runs = (2.0 * (high[:, 1:] != high[:, :-1]).sum(axis=1) - (n - 1)) / math.sqrt(n - 1)
    centred = 2 * symbols.astype(np.int32) - (size - 1)
    serial = 3.0 * (centred[:, 1:].astype(np.int64) * centred[:, :-1]).sum(axis=1) / (size * size - 1) / math.sqrt(n - 1)
    half = sum(SURPRISE[np.minimum(np.abs(z) * STEPS, len(SURPRISE) - 1).astype(np.int64)] for z in (chi, runs, serial))
    bits = (half - np.log(1 + half + half * half / 2)) / math.log(2)  # chi-squared with six degrees of freedom
    return np.clip(np.floor(4 * bits), 0, TOP).astype(np.int64)


def stratum(size: int, length: int) -> int:
    return SIZES.index(size) * len(LENGTHS) + int(np.searchsorted(LENGTHS, length, side="right")) - 1


def encoding_of(string: str) -> int:
    """The place of the smallest alphabet that holds a candidate; letters alone are read without their case."""
    used = set(string.lower() if string.isalpha() else string)
    return next(k for k, symbols in enumerate(SETS) if used <= symbols)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``start, kind, end`` of the base patterns, by start and kind."""
    found = []
    low = text.encode("utf-8", "surrogatepass").lower()
    if any(word in low for word in KEYWORDS):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(1) - m.start(1) >= 12]
    if b"akia" in low:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 18]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def candidates(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int, int, int]]:
    """``start, end, stratum, level, key`` of the candidates that touch no base span."""
    out = []
    taken, at = sorted((s, e) for s, _, e in base), 0
    reach = 0  # end of the base spans that begin before the candidate's end
    for m in CANDIDATE.finditer(text):
        start, end = m.span()
        while at < len(taken) and taken[at][0] < end:
            reach, at = max(reach, taken[at][1]), at + 1
        if reach > start:
            continue
        string = m.group(1)
        kind = encoding_of(string)
        size = len(ALPHABETS[kind])
        symbols = VALUES[kind][np.frombuffer((string.lower() if string.isalpha() else string).encode(), np.uint8)]
        level = int(levels(symbols[None, :], size)[0])
        out.append((start, end, stratum(size, len(string)), level, xxhash.xxh64_intdigest(string) - (1 << 63)))
    return out


def decoys(texts: list[str]) -> np.ndarray:
    """How often ordinary text of each stratum has each level: each text in pieces of every length, in turn."""
    out = np.zeros((len(SIZES) * len(LENGTHS), TOP + 1), np.int64)
    letters = [t.encode("utf-8", "surrogatepass").translate(None, OTHERS) for t in texts]
    lengths = np.array([len(x) for x in letters], np.int64)
    starts = np.cumsum(lengths) - lengths
    flat = np.frombuffer(b"".join(letters), np.uint8)
    turn, before = sum(LENGTHS), 0
    for k, n in enumerate(LENGTHS):
        pieces = np.maximum(0, (lengths - before - n) // turn + 1) * (lengths >= before + n)
        first = np.repeat(starts + before, pieces)
        nth = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        places = first + turn * nth
        for at in range(0, len(places), max(1, CELLS // n)):
            rows = flat[places[at : at + max(1, CELLS // n), None] + np.arange(n)]
            for j, size in enumerate(SIZES):
                out[j * len(LENGTHS) + k] += np.bincount(levels(WRITTEN[size][rows], size), minlength=TOP + 1)
        before += n
    return out


SPAN = "struct<start:int,kind:int,end:int>"
CANDIDATES = "array<struct<start:int,end:int,stratum:int,level:int,key:long>>"
DECOYS = "array<struct<stratum:int,level:int,n:long>>"
SCANNED = f"doc_id long, base array<{SPAN}>, candidates {CANDIDATES}, decoys {DECOYS}"


def _slices(texts: list[str]) -> Iterator[list[str]]:
    """Texts in runs of about a million characters: what is computed at once stays small."""
    part, chars = [], 0
    for text in texts:
        part.append(text)
        chars += len(text)
        if chars >= CELLS:
            yield part
            part, chars = [], 0
    yield part


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    release()
    for batch in batches:
        if not batch.num_rows:
            continue
        texts = [t or "" for t in batch.column("text").to_pylist()]
        base = [base_spans(t) for t in texts]
        tested = [candidates(t, b) for t, b in zip(texts, base, strict=True)]
        counts = sum(decoys(part) for part in _slices(texts))
        ordinary = [(int(s), int(v), int(counts[s, v])) for s, v in np.argwhere(counts)]
        rows = {
            "doc_id": batch.column("doc_id"),
            "base": [[dict(zip(("start", "kind", "end"), x, strict=True)) for x in b] for b in base],
            "candidates": [[dict(zip(("start", "end", "stratum", "level", "key"), x, strict=True)) for x in c] for c in tested],
            # One row of the batch carries the sums of all its texts.
            "decoys": [[dict(zip(("stratum", "level", "n"), x, strict=True)) for x in ordinary]] + [[]] * (len(texts) - 1),
        }
        span = pa.struct([(n, pa.int32()) for n in ("start", "kind", "end")])
        tests = pa.struct([*[(n, pa.int32()) for n in ("start", "end", "stratum", "level")], ("key", pa.int64())])
        sums = pa.struct([("stratum", pa.int32()), ("level", pa.int32()), ("n", pa.int64())])
        kinds = [pa.int64(), pa.list_(span), pa.list_(tests), pa.list_(sums)]
        yield pa.RecordBatch.from_arrays([v if k == "doc_id" else pa.array(v, t) for (k, v), t in zip(rows.items(), kinds, strict=True)], list(rows))


@dataclass(frozen=True)
class Discovery:
    """The rate of false discoveries that the added spans may have in a stratum."""

    rate: float = 0.01


DEFAULT = Discovery()


def thresholds(scanned: DataFrame, how: Discovery = DEFAULT) -> DataFrame:
    """``stratum, highest``: the highest level of each stratum (70 at most) that is a discovery; none, no row.

    Candidates count once a string, however many copies hold it.
    """
    strings = scanned.select(F.explode("candidates").alias("c")).select("c.stratum", "c.level", "c.key").distinct()
    tested = strings.groupBy("stratum", "level").agg(F.count("*").alias("c"), F.lit(0).cast("long").alias("d"))
    ordinary = scanned.select(F.explode("decoys").alias("x")).groupBy("x.stratum", "x.level")
    ordinary = ordinary.agg(F.lit(0).cast("long").alias("c"), F.sum("x.n").alias("d"))
    both = tested.union(ordinary).groupBy("stratum", "level").agg(F.sum("c").alias("c"), F.sum("d").alias("d"))
    # One row a level: 256 at most in a window.
    upto = Window.partitionBy("stratum").orderBy("level").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy("stratum")
    sums = both.select("stratum", "level", *[F.sum(x).over(w).alias(x + n) for x in "cd" for w, n in ((upto, "_upto"), (whole, "_all"))])
    chance = (F.col("d_upto") + 1) / (F.col("d_all") + 1)
    kept = sums.where((F.col("c_upto") > 0) & (chance * F.col("c_all") <= how.rate * F.col("c_upto")))
    return kept.groupBy("stratum").agg(F.max("level").alias("highest"))


def _discovered(found: DataFrame) -> dict[int, int]:
    return {r.stratum: r.highest for r in found.collect()}  # a row for each stratum at most


def scan(docs: DataFrame, how: Discovery = DEFAULT) -> DataFrame:
    """``doc_id, base, added`` for every row: spans ``start, kind, end`` in code points, by start and kind.

    Kinds are places in ``KINDS``; ``added`` are the strings that the tests find, none of which touches a
    base span.  Null and empty texts have no spans, repeated rows count each (their strings once), very
    long strings are tested whole, and an empty table gives no rows.  Where the table holds too little
    ordinary text to judge a stratum by, nothing is added there.
    """
    prepared(docs.sparkSession)
    rows = own_columns(docs, "doc_id", "text")
    scanned = written(rows.mapInArrow(_scan, SCANNED), "scanned")
    highest = _discovered(thresholds(scanned, how))
    random = F.filter("candidates", _is_random(highest))
    added = F.transform(random, lambda c: F.struct(c["start"].alias("start"), F.lit(3).alias("kind"), c["end"].alias("end")))
    return scanned.select("doc_id", "base", added.alias("added"))


def _is_random(highest: dict[int, int]):
    if not highest:
        return lambda c: F.lit(False)
    limits = F.create_map(*[F.lit(x) for pair in sorted(highest.items()) for x in pair])
    return lambda c: F.coalesce(c["level"] <= F.element_at(limits, c["stratum"]), F.lit(False))


def told(spans: Column) -> Column:
    """Spans as ``kind:start:end``, comma-joined by start and kind."""
    names = F.array(*[F.lit(k) for k in KINDS])
    each = F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"]))
    return F.array_join(each, ",")


def redacted(docs: DataFrame, how: Discovery = DEFAULT) -> DataFrame:
    """``docs`` with its own columns, every secret in ``text`` replaced by its kind in brackets; null stays null."""
    prepared(docs.sparkSession)
    scanned = written(own_columns(docs, "doc_id", "text").mapInArrow(_scan, SCANNED), "scanned")
    highest = _discovered(thresholds(scanned, how))

    def cleaned(text: str | None) -> str | None:
        if not text:
            return text
        spans = base_spans(text)
        spans += [(s, 3, e) for s, e, group, level, _ in candidates(text, spans) if level <= highest.get(group, -1)]
        out, at = [], 0
        for start, kind, end in sorted(spans):
            if start >= at:
                out += [text[at:start], f"[{KINDS[kind]}]"]
            at = max(at, end)
        return "".join([*out, text[at:]])

    clean = F.pandas_udf(lambda texts: pd.Series([cleaned(t) for t in texts], dtype=object), "string")
    return docs.withColumn("text", clean(docs["text"]))
