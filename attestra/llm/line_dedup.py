"""Line dedup by an exact set-similarity join: a line that is similar to an earlier one is removed.

A line is the set of its words (ASCII letters lower-cased).  Two lines are similar when the Jaccard
similarity of their sets reaches the threshold ``p / q``.  Equal sets are collapsed first (for lines of few words that is all).  Words of a
set are ordered by rarity over all lines; similar sets share a word among their first ``n - ceil(n p/q)
+ 1`` ones, so only sets that share such a word are compared.  Pairs are dropped by length, by the place
of the shared word, and by a 128-bit parity signature (the difference of two sets is at least the
difference of their signatures); none of this can drop a similar pair.  The words of the pairs that are
left are read again from the texts and compared exactly.

The rows of sets and words are shuffled many at once, one row for each bucket of words that a task has filled.
Words shared by many sets: their sets are dealt into blocks of bounded size, and pairs of blocks are
compared in different tasks.  For each set and shared word only the few partners with the nearest
signatures are verified at first, so groups of near copies cost a few rows a member; sets whose nearest
partners all turn out dissimilar are compared with all others in a second round.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attestra.llm.common import own_columns, prepared, small_side, written
from attestra.llm.encoding import release
from attestra.llm.tables import collected, frequency_level, frequency_levels, presence, slots_of, task_counts
from attestra.llm.words import BITS, flat, hashes, line_counts, lines, mixed

PAIRS = 1 << 20  # pairs that are compared at once
DEALT = 1 << 18  # rows of sets and words that a task deals to buckets at once
BUCKET = 1 << 17  # rows of a bucket, on average, unless the table is small
MOST_BLOCKS = 60_000  # pairs of blocks are numbered in 32 bits: beyond, blocks grow instead of their number
PLACE = ("doc_id", "row_key", "line")
LINES = pa.schema(
    [("doc_id", pa.int64()), ("row_key", pa.int64()), ("line", pa.int32()), ("k1", pa.int64()), ("k2", pa.int64())]
    + [("size", pa.int32()), ("s1", pa.int64()), ("s2", pa.int64()), ("prefix", pa.binary())]
)
KINDS = {"int64": "long", "int32": "int", "binary": "binary"}
ROWS = ("key", "id", "pack", "s1", "s2")


@dataclass(frozen=True)
class Similarity:
    """Jaccard of at least ``p / q``, between lines of at least ``least_words`` distinct words; shorter ones equal others."""

    p: int = 4
    q: int = 5
    least_words: int = 5
    bits: int = 20  # slots of the table of word frequencies
    block: int = 2048  # sets that share a word and are compared in one task
    nearest: int = 3  # partners of a set and shared word that are verified in the first round


DEFAULT = Similarity()


def words_of(line: bytes) -> set[bytes]:
    """``line`` is UTF-8; ASCII letters are lower-cased, ASCII white space separates words."""
    return set(line.lower().split())


def _slots(words: np.ndarray, bits: int) -> np.ndarray:
    return (words >> np.uint64(BITS - bits)).astype(np.int64)


def _count_words(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    """For each slot, how often one of its words occurs in the texts of the task."""
    release()
    counts = np.zeros(1 << bits, np.int64)
    held: list[np.ndarray] = []
    for found in (h for batch in batches for h in hashes(batch.column("text"))):
        held.append(_slots(found, bits))
        if sum(map(len, held)) >= PAIRS:
            counts += np.bincount(np.concatenate(held), minlength=1 << bits)
            held.clear()
    if held:
        counts += np.bincount(np.concatenate(held), minlength=1 << bits)
    yield from task_counts(counts)


def prefix_length(size: int, how: Similarity) -> int:
    return size - -(-size * how.p // how.q) + 1


def _describe(batches: Iterator[pa.RecordBatch], levels, how: Similarity) -> Iterator[pa.RecordBatch]:
    """Every line with words: where it is, its set's digest and signature, and the first words of longer ones.

    Every text has a row of size 0 besides, whose ``line`` counts its lines.
    """
    levels = levels.value
    one = np.uint64(1)
    for batch in batches:
        none = np.zeros(batch.num_rows, np.int64)
        columns = [batch.column("doc_id"), batch.column("row_key"), line_counts(batch.column("text")).astype(np.int32), none, none]
        columns += [none.astype(np.int32), none, none, _binary(np.zeros(0, np.uint32), none)]
        yield pa.RecordBatch.from_arrays([pa.array(c) if isinstance(c, np.ndarray) else c for c in columns], schema=LINES)
        for found in lines(batch.column("text")):
            if not len(found.sizes):
                continue
            words, owner, sizes = found.words, found.owner, found.sizes
            starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            k1 = np.add.reduceat(mixed(words, 1), starts)
            spread = mixed(words, 2)
            k2 = np.add.reduceat(spread, starts)
            bit = one << (spread & np.uint64(63))
            low = (spread >> np.uint64(6)) & one == 0
            s1 = np.bitwise_xor.reduceat(np.where(low, bit, np.uint64(0)), starts)
            s2 = np.bitwise_xor.reduceat(np.where(low, np.uint64(0), bit), starts)
            # Rarest first, within each line; the leading 32 bits of a word stand for it.
            level = levels[_slots(words, how.bits)].astype(np.uint64)
            order = np.sort((owner.astype(np.uint64) << np.uint64(44)) | (level << np.uint64(36)) | (words >> np.uint64(BITS - 36)))
            lengths = np.where(sizes >= how.least_words, prefix_length(sizes, how), 0)  # shorter ones only repeat
            first = np.arange(len(words)) - np.repeat(starts, sizes) < np.repeat(lengths, sizes)
            tokens = ((order[first] >> np.uint64(4)) & np.uint64(0xFFFFFFFF)).astype(np.uint32)
            place = pa.array(found.text)
            columns = [batch.column("doc_id").take(place), batch.column("row_key").take(place), pa.array(found.number.astype(np.int32))]
            columns += [pa.array(k.view(np.int64)) for k in (k1, k2)] + [pa.array(sizes.astype(np.int32))]
            columns += [pa.array(k.view(np.int64)) for k in (s1, s2)] + [_binary(tokens, lengths)]
            yield pa.RecordBatch.from_arrays(columns, schema=LINES)


def _binary(tokens: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """So many of the tokens for each row, as bytes."""
    offsets = np.concatenate([[0], np.cumsum(4 * lengths)]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(lengths), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(tokens))])


def _tokens(prefix: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All tokens of a column of ``_binary``, and how many each row has."""
    offsets = np.frombuffer(prefix.buffers()[1], np.int32)[prefix.offset : prefix.offset + len(prefix) + 1]
    data = prefix.buffers()[2]
    if data is None or offsets[0] == offsets[-1]:
        return np.zeros(0, np.uint32), np.diff(offsets) // 4
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]].view(np.uint32), np.diff(offsets) // 4


def _count_tokens(batches: Iterator[pa.RecordBatch], levels, how: Similarity) -> Iterator[pa.RecordBatch]:
    """``token, n`` of the tokens that may be in more sets than a block takes, by the frequency of their words."""
    # Counted in texts, a word occurs as often as it is in sets at least.
    may = levels.value >= frequency_level(how.block + 1)
    held: list[np.ndarray] = []

    def counted() -> pa.RecordBatch:
        tokens, n = np.unique(np.concatenate(held), return_counts=True)
        held.clear()
        return pa.RecordBatch.from_arrays([pa.array(tokens.view(np.int32)), pa.array(n.astype(np.int64))], ["token", "n"])

    for batch in batches:
        tokens, _ = _tokens(batch.column("prefix"))
        held.append(tokens[may[tokens >> np.uint32(32 - how.bits)]])
        if sum(map(len, held)) >= DEALT:
            yield counted()
    if held:
        yield counted()


def _rows(batches: Iterator[pa.RecordBatch], blocks, how: Similarity) -> Iterator[np.ndarray]:
    """``ROWS`` in parts: one for each set and word of its prefix, or for each pair of its block with another.

    ``key`` is the word and, where many sets share it, a pair of blocks; ``pack`` is the size, the place
    of the word, whether the pair is of two blocks and whether the set is in the higher one.
    """
    blocks = blocks.value
    for batch in batches:
        tokens, lengths = _tokens(batch.column("prefix"))
        of = np.repeat(np.arange(len(lengths)), lengths)
        pos = np.arange(len(tokens)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        ids, sizes, s1, s2 = (batch.column(n).to_numpy() for n in ("id", "size", "s1", "s2"))
        n = np.maximum(blocks[tokens >> np.uint32(32 - how.bits)].astype(np.int64), 1)
        bounds = np.concatenate([[0], np.cumsum(n)])
        at = 0
        while at < len(tokens):
            to = max(at + 1, int(np.searchsorted(bounds, bounds[at] + DEALT, side="right")) - 1)
            many = n[at:to]
            row = np.repeat(np.arange(at, to), many)
            other = np.arange(len(row)) - np.repeat(bounds[at:to] - bounds[at], many)
            row_of = of[row]
            block = (mixed(ids[row_of].view(np.uint64), 3) % n[row].astype(np.uint64)).astype(np.int64)
            low, high = np.minimum(block, other), np.maximum(block, other)
            mark = np.where(low != high, 2 + (block > other), 0)
            key = (tokens[row].astype(np.uint64) << np.uint64(32)).view(np.int64) | (high * (high + 1) // 2 + low)
            pack = sizes[row_of].astype(np.int64) << 32 | pos[row] << 2 | mark
            yield np.stack([key, ids[row_of], pack, s1[row_of], s2[row_of]])
            at = to


def _word_rows(batches: Iterator[pa.RecordBatch], blocks, how: Similarity, wanted=None) -> Iterator[pa.RecordBatch]:
    """``ROWS`` as columns; with ``wanted`` only those whose word shares a slot with a wanted one."""
    for rows in _rows(batches, blocks, how):
        if wanted is not None:
            rows = rows[:, wanted.value[slots_of(rows[0].view(np.uint64), how.bits)]]
        yield pa.RecordBatch.from_arrays([pa.array(r) for r in rows], list(ROWS))


def _bucket_rows(batches: Iterator[pa.RecordBatch], blocks, bits: int, how: Similarity) -> Iterator[pa.RecordBatch]:
    """One row for each bucket of keys: the bytes of its ``ROWS``, column after column."""

    def dealt() -> pa.RecordBatch:
        rows = np.concatenate(held, axis=1)
        held.clear()
        bucket = mixed(rows[0].view(np.uint64), 4) >> np.uint64(64 - bits)
        order = np.argsort(bucket)
        bucket = bucket[order]
        starts = np.nonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))[0]
        rows = rows[:, order]
        parts = [rows[:, a:b].tobytes() for a, b in zip(starts, np.append(starts[1:], len(bucket)), strict=True)]
        return pa.RecordBatch.from_arrays([pa.array(bucket[starts].astype(np.int32)), pa.array(parts, pa.binary())], ["bucket", "rows"])

    held: list[np.ndarray] = []
    for rows in _rows(batches, blocks, how):
        held.append(rows)
        if sum(h.shape[1] for h in held) >= DEALT:
            yield dealt()
    if held:
        yield dealt()


def _needed(a, b, how: Similarity) -> np.ndarray:
    """The least common words of two sets of sizes ``a`` and ``b`` that are similar."""
    return -(-(a + b) * how.p // (how.p + how.q))


class _Bucket:
    """Sets that share a word, as columns sorted by group and size; compares them pair by pair."""

    def __init__(self, columns: dict[str, np.ndarray], how: Similarity):
        self.c, self.how = columns, how

    def passing(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Pairs of rows of one group that pass all filters, and the difference of their signatures, in parts."""
        c, how = self.c, self.how
        group, size = c["group"], c["size"]
        # Sizes are at most p/q apart: the partners after a row end where the size passes n * q / p.
        reach = size * how.q // how.p
        widest = int(size.max()) * how.q // how.p + 2
        ends = np.searchsorted(group * widest + size, group * widest + reach, side="right")
        rows = np.arange(len(size))
        counts = np.maximum(ends - rows - 1, 0)
        bounds = np.concatenate([[0], np.cumsum(counts)])
        at = 0
        while at < len(size):
            to = max(at + 1, int(np.searchsorted(bounds, bounds[at] + PAIRS, side="right")) - 1)
            n = counts[at:to]
            i = np.repeat(rows[at:to], n)
            j = i + 1 + np.arange(len(i)) - np.repeat(bounds[at:to] - bounds[at], n)
            yield self._filtered(i, j)
            at = to

    def _filtered(self, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        c = self.c
        need = _needed(c["size"][i], c["size"][j], self.how)
        common = np.minimum(c["size"][i] - c["pos"][i], c["size"][j] - c["pos"][j])
        differ = np.bitwise_count(c["s1"][i] ^ c["s1"][j]).astype(np.int64) + np.bitwise_count(c["s2"][i] ^ c["s2"][j])
        # Between two blocks only sets of different blocks are compared.
        apart = ~c["mixed"][i] | (c["side"][i] != c["side"][j])
        good = (common >= need) & (differ <= c["size"][i] + c["size"][j] - 2 * need) & apart
        return i[good], j[good], differ[good]


def _candidates(batches: Iterator[pa.RecordBatch], how: Similarity, every: bool) -> Iterator[pa.RecordBatch]:
    """Pairs ``later, earlier, more``: for each set and group its nearest partners and whether it has others.

    With ``every``, all partners of the sets that are flagged ``open``.  Input is sorted by its first column,
    a bucket of groups (of ``_bucket_rows``) or the group's ``key``; rows are held until these are complete.
    """
    held: list[pa.RecordBatch] = []
    size = 0

    def columns(table: pa.Table) -> dict[str, np.ndarray]:
        if "rows" not in table.column_names:
            return {n: table.column(n).to_numpy() for n in table.column_names}
        parts = [np.frombuffer(p.as_buffer(), np.int64).reshape(len(ROWS), -1) for p in table.column("rows")]
        return dict(zip(ROWS, np.concatenate(parts, axis=1), strict=True))

    def answer(table: pa.Table) -> pa.RecordBatch:
        c = columns(table)
        # Groups of one row have no pairs.
        order = np.argsort(c["key"])
        key = c["key"][order]
        again = key[1:] == key[:-1]
        shared = np.concatenate([again, [False]]) | np.concatenate([[False], again])
        order, key = order[shared], key[shared]
        c = {n: v[order] for n, v in c.items()}
        c["s1"], c["s2"] = c["s1"].view(np.uint64), c["s2"].view(np.uint64)
        c["size"], rest = c["pack"] >> 32, c["pack"] & 0xFFFFFFFF
        c["pos"], c["mixed"], c["side"] = rest >> 2, (rest & 2) > 0, (rest & 1) > 0
        c["group"] = np.cumsum(np.diff(key, prepend=key[:1]) != 0)
        order = np.lexsort((c["size"], c["group"]))
        c = {n: v[order] for n, v in c.items()}
        found: list[np.ndarray] = []
        for i, j, differ in _Bucket(c, how).passing() if len(key) else ():
            a, b = c["id"][i], c["id"][j]
            later, earlier = np.maximum(a, b), np.minimum(a, b)
            use = later != earlier
            if every:
                use &= np.where(a > b, c["open"][i], c["open"][j])
            found.append(np.stack([c["group"][i], later, earlier, differ, np.zeros_like(later)])[:, use])
            if not every and sum(f.shape[1] for f in found) > 4 * PAIRS:
                found = [_nearest(np.concatenate(found, axis=1), how.nearest)]
        pairs = np.concatenate(found, axis=1) if found else np.zeros((5, 0), np.int64)
        if not every:
            pairs = _nearest(pairs, how.nearest)
        return pa.RecordBatch.from_arrays(
            [pa.array(pairs[1]), pa.array(pairs[2]), pa.array(pairs[4] > 0)], ["later", "earlier", "more"]
        )

    def ends_at(table: pa.Table) -> int:
        """Rows before the last group or bucket, which may go on in the next batch."""
        keys = table.column(0).to_numpy()
        other = np.nonzero(keys != keys[-1])[0]
        return int(other[-1]) + 1 if len(other) else 0

    def width(batch: pa.RecordBatch) -> int:
        """Rows of sets and words in it."""
        if "rows" not in batch.schema.names:
            return batch.num_rows
        return sum(len(p.as_buffer()) for p in batch.column("rows")) // (8 * len(ROWS))

    for batch in batches:
        held.append(batch)
        size += width(batch)
        if size >= 1 << 16 and (len(held) == 1 or batch.column(0)[-1] != held[0].column(0)[0]):
            table = pa.Table.from_batches(held)
            cut = ends_at(table)
            if cut:
                yield answer(table.slice(0, cut))
            held = table.slice(cut).to_batches()
            size = sum(map(width, held))
    if size:
        yield answer(pa.Table.from_batches(held))


def _nearest(pairs: np.ndarray, count: int) -> np.ndarray:
    """Of rows ``group, later, earlier, differ, more`` the nearest of each (group, later); ``more`` of the first
    counts what is left out."""
    if not pairs.shape[1]:
        return pairs
    pairs = pairs[:, np.lexsort((pairs[2], pairs[3], pairs[1], pairs[0]))]
    group, later = pairs[0], pairs[1]
    starts = np.nonzero(np.concatenate([[True], (group[1:] != group[:-1]) | (later[1:] != later[:-1])]))[0]
    sizes = np.diff(np.append(starts, len(group)))
    rank = np.arange(len(group)) - np.repeat(starts, sizes)
    left_out = np.add.reduceat(pairs[4], starts) + np.maximum(sizes - count, 0)
    pairs[4] = 0
    pairs[4, starts] = left_out
    return pairs[:, rank < count]


def _place_slots_of(doc_id: pa.Array, row_key: pa.Array, counts: np.ndarray, line: np.ndarray, bits: int) -> np.ndarray:
    """The slots of places: lines of documents that have so many of them."""
    document = mixed(doc_id.fill_null(0).to_numpy().view(np.uint64), 5) ^ mixed(row_key.to_numpy().view(np.uint64), 6)
    document[doc_id.is_null().to_numpy(zero_copy_only=False)] += np.uint64(1)
    return slots_of(mixed(np.repeat(document, counts) + line.astype(np.uint64), 7), bits)


def _place_slots(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        doc_id, row_key, line = (batch.column(n) for n in PLACE)
        slots = _place_slots_of(doc_id, row_key, np.ones(len(line), np.int64), line.to_numpy(), bits)
        yield pa.RecordBatch.from_arrays([pa.array(slots.astype(np.int32))], ["slot"])


def _fetch(batches: Iterator[pa.RecordBatch], wanted, bits: int, least: int) -> Iterator[pa.RecordBatch]:
    """Words of the lines that are wanted (and of some that share a slot with one)."""
    wanted = wanted.value
    types = [pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.string())]
    for batch in batches:
        doc_id, row_key, text = (batch.column(n) for n in ("doc_id", "row_key", "text"))
        counts = line_counts(text)
        starts = np.cumsum(counts) - counts
        line = np.arange(counts.sum()) - np.repeat(starts, counts)
        hits = np.nonzero(wanted[_place_slots_of(doc_id, row_key, counts, line, bits)])[0]
        owners = np.searchsorted(starts + counts, hits, side="right")
        data, offsets = flat(text)
        out: list[tuple] = []
        last, cut = -1, []
        for owner, number in zip(owners.tolist(), line[hits].tolist(), strict=True):
            if owner != last:
                last, cut = owner, data[offsets[owner] : offsets[owner + 1]].tobytes().split(b"\n")
            if len(cut[number]) >= 2 * least - 1:
                out.append((doc_id[owner].as_py(), row_key[owner].as_py(), number, [w.decode() for w in sorted(words_of(cut[number]))]))
        columns = zip(*out, strict=True) if out else [[]] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], [*PLACE, "words"])


def _on_place(left: str, right: str):
    """Places are equal, a null ``doc_id`` to itself."""
    same = F.col(f"{left}.doc_id").eqNullSafe(F.col(f"{right}.doc_id"))
    for n in PLACE[1:]:
        same = same & (F.col(f"{left}.{n}") == F.col(f"{right}.{n}"))
    return same


class _Join:
    """The steps of the join over one table of texts (``doc_id, row_key, text``)."""

    def __init__(self, texts: DataFrame, how: Similarity):
        self.texts, self.how, self.spark = texts, how, texts.sparkSession

    def lines(self) -> DataFrame:
        """Rows of ``_describe``."""
        how = self.how
        counted = self.texts.select("text").mapInArrow(partial(_count_words, bits=how.bits), "row int, counts binary")
        self.levels = self.spark.sparkContext.broadcast(frequency_levels(counted, how.bits))
        schema = ", ".join(f"{f.name} {KINDS[str(f.type)]}" for f in LINES)
        return written(self.texts.mapInArrow(partial(_describe, levels=self.levels, how=how), schema), "lines")

    def sets(self, lines: DataFrame) -> DataFrame:
        """One row a set: how often and where first it occurs, and an ``id`` that rises in that order."""
        first = F.min(F.struct(*PLACE)).alias("at")
        rest = F.first(F.struct("s1", "s2", "prefix")).alias("x")  # the same for equal sets
        sets = lines.where("size > 0").groupBy("k1", "k2", "size").agg(first, rest, F.count("*").alias("n")).select("k1", "k2", "size", "n", "at.*", "x.*")
        order = [F.col(PLACE[0]).asc_nulls_first(), *PLACE[1:]]
        ranged = sets.repartitionByRange(*order).sortWithinPartitions(*order)
        return written(ranged.withColumn("id", F.monotonically_increasing_id()), "sets")

    def blocks(self, sets: DataFrame):
        """Into how many blocks the sets of a word are dealt, for each slot of words: the most that one of them needs.

        0 for slots without a word that is in more sets than a block takes.
        """
        how = self.how
        counted = sets.select("prefix").mapInArrow(partial(_count_tokens, levels=self.levels, how=how), "token int, n long")
        hot = counted.groupBy("token").agg(F.sum("n").alias("n")).where(F.col("n") > how.block)
        most = F.max(F.least(F.ceil(F.col("n") / how.block), F.lit(MOST_BLOCKS)))
        slots = hot.groupBy(F.shiftrightunsigned("token", 32 - how.bits).alias("slot")).agg(most.alias("level"))
        return self.spark.sparkContext.broadcast(collected(slots, how.bits, np.uint16))

    def candidates(self, sets: DataFrame, blocks) -> DataFrame:
        how = self.how
        words = sets.agg(F.sum(F.length("prefix"))).first()[0] or 0
        bits = min(max((words // 4 // BUCKET).bit_length(), 10), 30)
        bucket_rows = partial(_bucket_rows, blocks=blocks, bits=bits, how=how)
        rows = sets.select("id", "size", "s1", "s2", "prefix").mapInArrow(bucket_rows, "bucket int, rows binary")
        dealt = rows.repartition("bucket").sortWithinPartitions("bucket")
        return dealt.mapInArrow(partial(_candidates, how=how, every=False), "later long, earlier long, more boolean")

    def every_candidate(self, sets: DataFrame, blocks, left: DataFrame) -> DataFrame:
        """All pairs of the sets whose ``id`` is in ``left``."""
        how = self.how
        columns, schema = ("id", "size", "s1", "s2", "prefix"), ", ".join(f"{n} long" for n in ROWS)
        own = sets.join(left, "id", "left_semi").select(*columns).mapInArrow(partial(_word_rows, blocks=blocks, how=how), schema)
        keys = written(own.select("key").distinct(), "keys")
        # The leading bits of a key are those of its word.
        wanted = presence(keys.select(F.shiftrightunsigned("key", 64 - how.bits).cast("int").alias("slot")), how.bits)
        word_rows = partial(_word_rows, blocks=blocks, how=how, wanted=self.spark.sparkContext.broadcast(wanted))
        asked = sets.select(*columns).mapInArrow(word_rows, schema).join(small_side(keys, row_bytes=16), "key", "left_semi")
        asked = asked.join(left.withColumn("open", F.lit(True)), "id", "left")
        dealt = asked.select(*ROWS, F.coalesce("open", F.lit(False)).alias("open")).repartition("key").sortWithinPartitions("key")
        return dealt.mapInArrow(partial(_candidates, how=how, every=True), "later long, earlier long, more boolean")

    def verified(self, pairs: DataFrame, sets: DataFrame) -> DataFrame:
        """The similar ones of distinct ``later, earlier`` pairs, by the words themselves."""
        how, bits = self.how, 23
        ids = pairs.select(F.explode(F.array("later", "earlier")).alias("id")).distinct()
        places = written(ids.join(sets.select("id", "size", *PLACE), "id"), "places")
        slots = places.select(*PLACE).mapInArrow(partial(_place_slots, bits=bits), "slot int")
        wanted = self.spark.sparkContext.broadcast(presence(slots, bits))
        fetched = self.texts.mapInArrow(
            partial(_fetch, wanted=wanted, bits=bits, least=how.least_words),
            "doc_id long, row_key long, line int, words array<string>",
        )
        # Rows equal in id and text are read twice.
        found = places.alias("p").join(fetched.alias("f"), _on_place("p", "f")).select("p.id", "f.words")
        found = written(found.dropDuplicates(["id"]), "words")
        a = found.select(F.col("id").alias("later"), F.col("words").alias("a"))
        b = found.select(F.col("id").alias("earlier"), F.col("words").alias("b"))
        both = pairs.join(a, "later").join(b, "earlier")
        common = F.size(F.array_intersect("a", "b"))
        return both.where((how.p + how.q) * common >= how.p * (F.size("a") + F.size("b"))).select("later", "earlier")

    def matched(self, sets: DataFrame) -> DataFrame:
        """``id`` of every set that is similar to one that occurs earlier."""
        blocks = self.blocks(sets)
        first = written(self.candidates(sets, blocks), "candidates")
        pairs = written(first.select("later", "earlier").distinct(), "pairs")
        good = written(self.verified(pairs, sets).select(F.col("later").alias("id")).distinct(), "matched")
        left = first.where("more").select(F.col("later").alias("id")).distinct().join(good, "id", "left_anti")
        left = written(left, "open")
        if left.isEmpty():
            return good
        # The rest: all partners of the sets that are still open, but for those just refused.
        every = self.every_candidate(sets, blocks, small_side(left, row_bytes=16))
        again = every.select("later", "earlier").distinct().join(pairs, ["later", "earlier"], "left_anti")
        more = self.verified(written(again, "pairs"), sets)
        return good.union(more.select(F.col("later").alias("id"))).distinct()


def _similar_lines(docs: DataFrame, how: Similarity) -> tuple[DataFrame, DataFrame]:
    """What ``similar_lines`` gives, and ``doc_id, row_key, n_lines`` of every row."""
    prepared(docs.sparkSession)
    texts = own_columns(docs, "doc_id", "text").withColumn("row_key", F.xxhash64(F.coalesce("text", F.lit(""))))
    join = _Join(texts.select("doc_id", "row_key", "text"), how)
    lines = join.lines()
    sets = join.sets(lines)
    similar = small_side(written(join.matched(sets), "similar"), row_bytes=16)
    verdict = sets.join(similar.withColumn("similar", F.lit(True)), "id", "left").where("similar or n > 1")
    verdict = verdict.select("k1", "k2", "size", F.struct(*PLACE).alias("first"), F.coalesce("similar", F.lit(False)).alias("similar"))
    placed = lines.where("size > 0").select(*PLACE, "k1", "k2", "size").join(verdict, ["k1", "k2", "size"])
    repeats = ~F.struct(*PLACE).eqNullSafe(F.col("first"))
    removed = placed.where(F.col("similar") | repeats)
    removed = removed.groupBy("doc_id", "row_key").agg(F.array_sort(F.collect_set("line")).alias("removed"))
    return removed, lines.where("size = 0").select("doc_id", "row_key", F.col("line").cast("long").alias("n_lines"))


def similar_lines(docs: DataFrame, how: Similarity = DEFAULT) -> DataFrame:
    """``doc_id, row_key, removed`` for every document that loses lines: their numbers, ascending, from 0.

    Lines are separated by ``\\n`` and ordered by ``doc_id`` (null first), a hash of the text
    (``row_key``) and their number.  A line with at least ``least_words`` distinct words is removed if an
    earlier line is similar; whether that one is removed itself makes no difference.  A shorter line is removed
    if an earlier one has the same words.  Blank lines stay.  Rows equal in ``doc_id`` and text are one document here and lose the
    same lines.  Null and empty texts lose none; an empty table gives no rows.
    """
    return _similar_lines(docs, how)[0]


def line_report(docs: DataFrame, how: Similarity = DEFAULT) -> DataFrame:
    """``doc_id, n_lines, n_removed, removed`` of every row; a null text has no lines, an empty one has one."""
    removed, rows = _similar_lines(docs, how)
    removed = written(removed, "removed")
    same = F.col("d.doc_id").eqNullSafe(F.col("r.doc_id")) & (F.col("d.row_key") == F.col("r.row_key"))
    joined = rows.alias("d").join(removed.alias("r"), same, "left")
    gone = F.coalesce("r.removed", F.array().cast("array<int>"))
    return joined.select("d.doc_id", "d.n_lines", F.size(gone).cast("long").alias("n_removed"), gone.alias("removed"))


def without_similar_lines(docs: DataFrame, how: Similarity = DEFAULT) -> DataFrame:
    """``docs`` with its own columns; texts have lost the removed lines, and ``n_chars`` counts what is left.

    A document that loses all its lines has an empty text.
    """
    removed = written(similar_lines(docs, how), "removed")
    removed = small_side(removed, row_bytes=40 + 4 * F.size("removed"))
    removed = removed.select(F.col("doc_id").alias("_r_id"), F.col("row_key").alias("_r_key"), F.col("removed").alias("_r_lines"))
    key = F.xxhash64(F.coalesce(docs["text"], F.lit("")))
    joined = docs.join(removed, docs["doc_id"].eqNullSafe(F.col("_r_id")) & (key == F.col("_r_key")), "left")
    lines = F.split(docs["text"], "\n", -1)
    left = F.filter(lines, lambda _, k: ~F.array_contains("_r_lines", k))
    text = F.when(F.col("_r_lines").isNull(), docs["text"]).otherwise(F.array_join(left, "\n"))
    out = [text.alias("text") if c == "text" else F.length(text).cast("long").alias(c) if c == "n_chars" else docs[f"`{c}`"] for c in docs.columns]
    return joined.select(*out)
