"""A prefix trie of conversations: which openings they share, and what storing each once would save.

A turn becomes an id of 16 bytes: the UTF-8 length of its text, big-endian, and 96 bits of a digest of role and
text.  A conversation is the string of its turns' ids.  Keys are sorted across the cluster by key and
conversation, so every subtree is a run of consecutive rows; a task cuts its rows into blocks of bounded
size and builds an adaptive radix tree of each (``radix``).  Prefixes that lie inside a block are finished
there.  Those of its first and last key may go on next door: there are two paths a block, they are stitched within
the task, then over groups of tasks until one group is left.  A prefix that all conversations share costs
a row a task, however many hold it.

The ids of the members that end at an open prefix leave the blocks as strings of some thousand ids, whose digest
is taken in order by a stream that holds one string at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial, reduce

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from attestra.llm.common import prepared, small_side, written
from attestra.llm.radix import Prefix, Tree, prefixes, stitch

CONVERSATIONS = 2048  # of a block
KEY_BYTES = 8 << 20  # of a block, but for one longer key
GROUP = 256  # runs that are stitched in one task

FINISHED, OPEN, ENDS = 0, 1, 2
FIELDS = [
    ("what", pa.int32()), ("run", pa.int64()), ("seq", pa.int32()), ("left", pa.bool_()), ("right", pa.bool_()), ("depth", pa.int64()),
    ("path", pa.binary()), ("parent", pa.binary()), ("size", pa.int64()), ("conv_id", pa.int64()), ("n_convs", pa.int64()),
    ("n_children", pa.int64()), ("n_leaves", pa.int64()), ("saved", pa.int64()), ("parent_conv_id", pa.int64()), ("ends", pa.string()),
]
SCHEMA = (
    "what int, run long, seq int, left boolean, right boolean, depth long, path binary, parent binary, size long, conv_id long, n_convs long, "
    "n_children long, n_leaves long, saved long, parent_conv_id long, ends string"
)


def turn_id(role: Column, text: Column) -> Column:
    """32 hexadecimal digits; equal for turns of equal role and text (null is empty)."""
    role, text = F.coalesce(role, F.lit("")), F.coalesce(text, F.lit(""))
    digest = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)
    return F.concat(F.lpad(F.hex(F.octet_length(text).cast("long")), 8, "0"), F.substring(digest, 1, 24))


def turns_of(conversations: DataFrame) -> DataFrame:
    """``conv_id, turns``: the turn ids of every conversation, by turn (null first), then role and text.

    Rows without a conversation take no part.  Texts are sorted in a stream; only ids are gathered, 16
    bytes a turn, so a conversation must fit a cell by its ids.
    """
    rows = conversations.select(
        *[conversations[c].alias(c) for c in ("conv_id", "turn")], *[F.coalesce(conversations[c], F.lit("")).alias(c) for c in ("role", "text")]
    ).where("conv_id is not null")
    order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "role", "text")
    numbered = rows.select("conv_id", F.row_number().over(order).alias("at"), turn_id(F.col("role"), F.col("text")).alias("id"))
    gathered = numbered.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("at", "id"))).alias("x"))
    return gathered.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("x.id").alias("turns"))


def _row(prefix: Prefix, what: int, run: int, seq: int) -> tuple:
    ends = hashlib.sha256((prefix.ends or "").encode()).hexdigest() if what == FINISHED and prefix.depth >= 0 else None
    return (
        what, run, seq, prefix.left, prefix.right, prefix.depth, prefix.path, prefix.parent, prefix.size, prefix.conv_id, prefix.n_convs,
        prefix.n_children, prefix.n_leaves, prefix.saved, prefix.parent_conv_id, ends,
    )


def _stitched(prefix: Prefix, run: int) -> tuple:
    """A finished prefix whose members may end in several blocks: their digest comes from the stream."""
    return (*_row(prefix, FINISHED, run, 0)[:-1], None)


def _batches(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
    for at in range(0, len(rows), 4096):
        columns = zip(*rows[at : at + 4096], strict=True)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, FIELDS, strict=True)], [n for n, _ in FIELDS])


def _blocks(batches: Iterator[pa.RecordBatch], conversations: int, key_bytes: int) -> Iterator[list[tuple[bytes, int]]]:
    block, size = [], 0
    for batch in batches:
        for key, conv_id in zip(batch.column("key"), batch.column("conv_id").to_pylist(), strict=True):
            key = key.as_py()
            if block and (len(block) >= conversations or size + len(key) > key_bytes):
                yield block
                block, size = [], 0
            block.append((key, conv_id))
            size += len(key)
    if block:
        yield block


def _grown(batches: Iterator[pa.RecordBatch], conversations: int, key_bytes: int) -> Iterator[pa.RecordBatch]:
    """The rows of a task: a tree for each block; the open prefixes of the blocks stitched to those of the task."""
    run, runs = TaskContext.get().partitionId(), []
    for block in _blocks(batches, conversations, key_bytes):
        tree = Tree()
        for key, conv_id in block:
            tree.add(key, conv_id)
        finished, still_open = prefixes(tree, block[0][0], block[-1][0])
        rows = [_row(p, FINISHED, run, 0) for p in finished]
        for p in still_open:
            if p.ends is not None:
                rows.append((*_row(p, ENDS, run, 0)[:9], int(p.ends.partition(",")[0]), *[None] * 5, p.ends))
        runs.append(still_open)
        if len(runs) >= 64:
            done, left = stitch(runs, whole=False)
            rows += [_stitched(p, run) for p in done]
            runs = [left]
        yield from _batches(rows)
    if runs:
        done, left = stitch(runs, whole=False)
        yield from _batches([_stitched(p, run) for p in done] + [_row(p, OPEN, run, k) for k, p in enumerate(left)])


def _joined(batches: Iterator[pa.RecordBatch], whole: bool) -> Iterator[pa.RecordBatch]:
    """Groups of runs, in order, stitched to one run each."""
    group, runs, run = None, [], None

    def out() -> Iterator[pa.RecordBatch]:
        done, left = stitch(runs, whole)
        yield from _batches([_stitched(p, group) for p in done] + [_row(p, OPEN, group, k) for k, p in enumerate(left)])

    for batch in batches:
        for r in batch.to_pylist():
            if r["group"] != group:
                if runs:
                    yield from out()
                group, runs, run = r["group"], [], None
            if r["run"] != run:
                run = r["run"]
                runs.append([])
            runs[-1].append(
                Prefix(
                    r["depth"], r["path"], r["parent"], r["size"], r["conv_id"], r["n_convs"], r["n_children"], r["n_leaves"], r["saved"],
                    left=r["left"], right=r["right"],
                )
            )
    if runs:
        yield from out()


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the strings of each path, joined by commas, in their order."""
    path, state = None, None
    for batch in batches:
        out = []
        for here, text in zip(batch.column("path").to_pylist(), batch.column("ends"), strict=True):
            if here != path:
                if path is not None:
                    out.append((path, state.hexdigest()))
                path, state = here, hashlib.sha256(text.as_py().encode())
            else:
                state.update(b"," + text.as_py().encode())
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], ["path", "digest"])
    if path is not None:
        yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([state.hexdigest()])], ["path", "digest"])


def prefix_trie(sequences: DataFrame, conversations: int = CONVERSATIONS, key_bytes: int = KEY_BYTES, group: int = GROUP) -> DataFrame:
    """The nodes of the trie over ``conv_id, turns`` (ids by ``turn_id``), one row a distinct prefix.

    ``path, parent`` (digests; root: null parent), ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``,
    ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens`` and ``ends_sha256`` (of the members that end there,
    ascending).  Conversations without turns are members of the root alone.  Conversations must be distinct.
    An empty table gives no rows, not even a root.
    """
    prepared(sequences.sparkSession)
    keyed = sequences.select("conv_id", F.unhex(F.array_join("turns", "")).alias("key"))
    keyed = written(keyed, "keys")
    ordered = keyed.repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id")
    made = written(ordered.mapInArrow(partial(_grown, conversations=conversations, key_bytes=key_bytes), SCHEMA), "prefixes")
    finished = [made.where(F.col("what") == FINISHED)]
    runs = made.where(F.col("what") == OPEN)
    most = made.agg(F.max("run")).first()[0]
    while most is not None:
        whole = most < group
        grouped = runs.withColumn("group", F.floor(F.col("run") / group).cast("long"))
        ordered = grouped.repartition("group").sortWithinPartitions("group", "run", "seq")
        joined = written(ordered.mapInArrow(partial(_joined, whole=whole), SCHEMA), "stitched")
        finished.append(joined.where(F.col("what") == FINISHED))
        runs = joined.where(F.col("what") == OPEN)
        most = None if whole else most // group
    every = reduce(DataFrame.union, finished)

    strings = made.where(F.col("what") == ENDS).select("path", "conv_id", "ends")
    streams = strings.repartition("path").sortWithinPartitions("path", "conv_id")
    digests = written(streams.mapInArrow(_digests, "path binary, digest string"), "digests")
    # Stitched prefixes are few, two paths a task; most others hang below one of them.
    stitched = written(every.where("ends is null").join(digests, "path", "left"), "late")
    none = F.sha2(F.lit("").cast("binary"), 256)
    stitched = stitched.withColumn("ends", F.coalesce("digest", none)).drop("digest")
    above = small_side(stitched.select(F.col("path").alias("parent"), F.col("conv_id").alias("_above")), row_bytes=64)
    both = every.where("ends is not null").unionByName(stitched)
    known = F.col("parent_conv_id").isNotNull() | F.col("parent").isNull()
    named = both.where(~known).join(above, "parent", "left").withColumn("parent_conv_id", F.col("_above")).drop("_above")
    return both.where(known).unionByName(named).select(
        "path", "parent", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
        F.col("saved").alias("saved_tokens"), F.col("ends").alias("ends_sha256"),
    )
