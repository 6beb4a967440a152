"""Benchmark decontamination by spaced-seed hashing.

A mask marks six of eleven neighbouring words; the others may differ.  The five masks are chosen so that
in any fifteen words of which three at most are substituted, one of them has a place that avoids the
substitutions.  The marked words' hashes of test and training texts are joined, and around every hit the
texts are compared word by word on that alignment: fifteen neighbouring words of which twelve or more
are equal are an overlap.  Items of five to fourteen words have masks over the whole item, which ignore blocks of
it so that any words that may differ are ignored by one mask.

A fixed-size table of the test hashes spares the training side from writing hashes that no test item
has; what passes it is joined exactly.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attestra.llm.common import own_columns, prepared, small_side, written
from attestra.llm.encoding import release
from attestra.llm.tables import presence, slots_of

MASKS = ("11001010011", "11010001101", "10101100101", "10001101101", "11011100001")
SPAN = 11
WINDOW = 15
LEAST_EQUAL = 12
SHORTEST = 5  # words of the shortest item that is looked for
MARKS = b".,;:!?\"'()[]"
BITS = 22  # slots of the table
PARTS = 3  # parts of a hash that must all be in the table
RUN = 128  # places of hits that share one excerpt of the text

ITEM = pa.schema([("item_id", pa.int64()), ("words", pa.list_(pa.int64()))])
HIT = pa.struct([("seed", pa.int64()), ("pos", pa.int32())])
RUNS = pa.schema(
    [("doc_id", pa.int64()), ("row_key", pa.int64()), ("first", pa.int32()), ("words", pa.list_(pa.int64())), ("hits", pa.list_(HIT))]
)


def word_hashes(text: str | None) -> np.ndarray:
    """A 64-bit hash of each word; ASCII letters are lower-cased and punctuation around words is ignored."""
    digest = xxhash.xxh64_intdigest
    return np.array([digest(w.strip(MARKS)) for w in (text or "").encode().lower().split()], dtype=np.uint64)


def _multipliers(n: int, salt: int) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(f"{salt},{k}") | 1 for k in range(n)], dtype=np.uint64)


def needed(size: int) -> int:
    """The equal words that a window of so many words needs."""
    return -(-size * LEAST_EQUAL // WINDOW)


def short_masks(size: int) -> list[np.ndarray]:
    """Masks over a whole item of 5 to 14 words: any words that may differ lie in blocks that one of them ignores."""
    wrong = size - needed(size)
    blocks = np.array_split(np.arange(size), wrong + 2)
    return [np.concatenate([b for k, b in enumerate(blocks) if k not in out]) for out in combinations(range(len(blocks)), wrong)]


def shapes_of(size: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Offsets and multipliers of the masks for items of so many words."""
    if size < WINDOW:
        return [(m, _multipliers(len(m), 1000 * size + k)) for k, m in enumerate(short_masks(size))]
    masks = [np.array([k for k, c in enumerate(m) if c == "1"]) for m in MASKS]
    return [(m, _multipliers(len(m), salt)) for salt, m in enumerate(masks)]


def shapes(short: list[int]) -> list[tuple[np.ndarray, np.ndarray]]:
    """The masks for long items, and those for the short lengths that occur."""
    return [shape for size in (WINDOW, *short) for shape in shapes_of(size)]


def seeds(hashes: np.ndarray, shape: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The hash of the marked words at every place of a mask."""
    offsets, multipliers = shape
    places = len(hashes) - int(offsets[-1])
    if places <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(places, np.uint64)
    for offset, multiplier in zip(offsets, multipliers, strict=True):
        total += hashes[offset : offset + places] * multiplier
    total ^= total >> np.uint64(32)
    return total * np.uint64(0x9E3779B97F4A7C15)


def _slot(found: np.ndarray, part: int) -> np.ndarray:
    """The slot of one part of each hash; part 0 are the highest bits."""
    return ((found >> np.uint64(64 - BITS - 21 * part)) & np.uint64((1 << BITS) - 1)).astype(np.int64)


def _items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        words = [word_hashes(t).view(np.int64) for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("item_id"), pa.array(words, ITEM.field("words").type)], schema=ITEM)


def _item_seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for item, words in zip(batch.column("item").to_pylist(), batch.column("words").to_pylist(), strict=True):
            hashes = np.array(words, np.int64).view(np.uint64)
            for shape in shapes_of(len(hashes)):
                found = seeds(hashes, shape)
                if len(hashes) < WINDOW:
                    found = found[:1]  # these masks span the whole item
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found.view(np.int64)), pa.array(np.full(len(found), item)), pa.array(np.arange(len(found), dtype=np.int32))],
                    ["seed", "item", "at"],
                )


def _find(batches: Iterator[pa.RecordBatch], table, short: list[int]) -> Iterator[pa.RecordBatch]:
    """Excerpts of texts with the places of hashes that a test item may have."""
    release()
    table, forms = table.value, shapes(short)
    for batch in batches:
        texts = [word_hashes(t) for t in batch.column("text").to_pylist()]
        sizes = np.array([len(t) for t in texts], np.int64)
        if not sizes.sum():
            continue
        every, ends = np.concatenate(texts), np.cumsum(sizes)
        owner = np.repeat(np.arange(len(texts)), sizes)
        found: list[tuple[np.ndarray, np.ndarray]] = []
        for shape in forms:
            made = seeds(every, shape)
            at = np.nonzero(table[slots_of(made, BITS)])[0]
            for part in range(1, PARTS):
                at = at[table[_slot(made[at], part)]]
            at = at[at + shape[0][-1] < ends[owner[at]]]  # inside one text
            found.append((at, made[at]))
        at = np.concatenate([f[0] for f in found])
        if not len(at):
            continue
        made = np.concatenate([f[1] for f in found]).view(np.int64)
        own = owner[at]
        place = at - (ends - sizes)[own]
        run = place // RUN
        order = np.lexsort((place, run, own))
        own, run, place, made = own[order], run[order], place[order], made[order]
        starts = np.nonzero(np.concatenate([[True], (own[1:] != own[:-1]) | (run[1:] != run[:-1])]))[0]
        rows = []
        for lo, hi in zip(starts, np.append(starts[1:], len(own)), strict=True):
            text = texts[own[lo]]
            first = max(0, int(place[lo]) - WINDOW)
            last = min(len(text), int(place[hi - 1]) + 2 * WINDOW)
            hits = [{"seed": int(s), "pos": int(p)} for s, p in zip(made[lo:hi], place[lo:hi], strict=True)]
            doc, key = (batch.column(n)[int(own[lo])].as_py() for n in ("doc_id", "row_key"))
            rows.append((doc, key, first, text[first:last].view(np.int64), hits))
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), RUNS, strict=True)], schema=RUNS)


def overlap(words: np.ndarray, first: int, item: np.ndarray, shift: int) -> tuple[int, int, int] | None:
    """Where a text (its ``words`` from place ``first`` on) agrees with an item that begins at place ``shift`` of it.

    Start and end of what windows of ``WINDOW`` words (or the whole shorter item) with enough equal
    words cover, and the equal words between; None without such a window.
    """
    lo, hi = max(first, shift), min(first + len(words), shift + len(item))
    window = min(WINDOW, len(item))
    if hi - lo < window:
        return None
    equal = words[lo - first : hi - first] == item[lo - shift : hi - shift]
    sums = np.concatenate([[0], np.cumsum(equal)])
    good = np.nonzero(sums[window:] - sums[:-window] >= needed(window))[0]
    if not len(good):
        return None
    start, end = int(good[0]), int(good[-1]) + window
    return lo + start, lo + end, int(sums[end] - sums[start])


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32()]
    names = ["doc_id", "row_key", "item_id", "start", "end", "n_equal"]
    for batch in batches:
        rows = []
        columns = [batch.column(n) for n in ("doc_id", "row_key", "item_id", "first", "words", "item_words", "shift")]
        for k in range(batch.num_rows):
            doc, key, item_id, first, words, item, shift = (c[k] for c in columns)
            found = overlap(words.values.to_numpy(), first.as_py(), item.values.to_numpy(), shift.as_py())
            if found:
                rows.append((doc.as_py(), key.as_py(), item_id.as_py(), *found))
        columns = zip(*rows, strict=True) if rows else [[]] * 6
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)


def overlaps(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id, row_key, item_id, start, end, n_equal``: texts that share a passage with a benchmark item.

    ``docs`` has ``doc_id, text``, ``benchmark`` has ``item_id, text``.  Places are words from 0, ``end``
    exclusive.  One row for each text and item: the first to the last word that overlaps cover, and the
    equal words of the longest.  Items of equal words are one, under their smallest id.  Items of five to
    fourteen words must be there whole, with the same share of equal words; items of fewer, empty and null ones are
    never found.
    Null and empty documents have no rows; rows equal in id and text share theirs; empty tables give none.
    """
    spark = prepared(docs.sparkSession)
    items = own_columns(benchmark, "item_id", "text").mapInArrow(_items, "item_id long, words array<long>")
    items = items.where(F.size("words") >= SHORTEST).groupBy("words").agg(F.min("item_id").alias("item_id"))
    items = written(items.withColumn("item", F.monotonically_increasing_id()), "items")
    made = written(items.select("item", "words").mapInArrow(_item_seeds, "seed long, item long, at int"), "seeds")
    size = F.size("words")
    short = sorted(r.n for r in items.where(size < WINDOW).select(size.alias("n")).distinct().collect())  # ten at most
    parts = [F.shiftrightunsigned("seed", 64 - BITS - 21 * k).bitwiseAND(F.lit((1 << BITS) - 1)).cast("int") for k in range(PARTS)]
    table = presence(made.select(F.explode(F.array(*parts)).alias("slot")), BITS)
    table = spark.sparkContext.broadcast(table)

    texts = own_columns(docs, "doc_id", "text").withColumn("row_key", F.xxhash64(F.coalesce("text", F.lit(""))))
    schema = "doc_id long, row_key long, first int, words array<long>, hits array<struct<seed: long, pos: int>>"
    runs = texts.select("doc_id", "row_key", "text").mapInArrow(partial(_find, table=table, short=short), schema)
    runs = written(runs.withColumn("run", F.monotonically_increasing_id()), "runs")
    hits = runs.select("run", F.explode("hits").alias("hit")).select("run", "hit.seed", "hit.pos")
    aligned = hits.join(small_side(made, row_bytes=32), "seed").select("run", "item", (F.col("pos") - F.col("at")).alias("shift")).distinct()
    whole = small_side(items.select("item", "item_id", F.col("words").alias("item_words")), row_bytes=32 + 8 * F.size("item_words"))
    compared = aligned.join(runs.drop("hits"), "run").join(whole, "item")
    found = compared.select("doc_id", "row_key", "item_id", "first", "words", "item_words", "shift").mapInArrow(
        _verify, "doc_id long, row_key long, item_id long, start int, end int, n_equal int"
    )
    return found.groupBy("doc_id", "row_key", "item_id").agg(
        F.min("start").alias("start"), F.max("end").alias("end"), F.max("n_equal").alias("n_equal")
    )


def without_benchmark(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the rows that share a passage with a benchmark item."""
    found = written(overlaps(docs, benchmark).select("doc_id", "row_key").distinct(), "leaks")
    found = small_side(found.select(F.col("doc_id").alias("_l_id"), F.col("row_key").alias("_l_key")), row_bytes=32)
    key = F.xxhash64(F.coalesce(docs["text"], F.lit("")))
    return docs.join(found, docs["doc_id"].eqNullSafe(F.col("_l_id")) & (key == F.col("_l_key")), "left_anti")
