"""Hard negatives of anchors by Fagin's threshold algorithm over blocks of integer vectors.

Rows are dealt into blocks of bounded size.  A block keeps, for each dimension, its rows in the order of
their component (a sorted list).  For an anchor the lists are read side by side, from the end its sign
asks for: falling where the anchor's component is positive, rising where it is negative.  Every row that
turns up is scored at once by random access, an exact integer inner product.  The threshold is the score
that a row would have which stood at the present place of every list; no row unseen can score higher.  A
search ends when the threshold lies strictly below the kth score of each of its windows (an equal score
may still win by a smaller id), when nothing below it can enter a window, or when all rows were seen.

What blocks find is merged by rank, so the result is that of all rows.  Anchors are a stated query set:
each goes to each block once, and no pairs of rows are ever written.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from attestra.llm.common import prepared, written

LIMIT = float(1 << 28)  # components are held within it: 64 products of two of them fit a long
FOUND = "anchor_id long, positive_id long, positive_score long, id long, score long"


@dataclass(frozen=True)
class Mining:
    """``positives`` of each anchor; ``negatives`` between ``low`` and ``high`` hundredths of a positive's score."""

    positives: int = 5
    negatives: int = 10
    low: int = 30
    high: int = 90
    first_depth: int = 32  # places of each list that are read first; then twice as many, and so on
    block_values: int = 1 << 19  # components of a block


DEFAULT = Mining()


def integer_rows(embeddings: DataFrame, scale: int = 256) -> DataFrame:
    """``vec_id, label, x`` with ``x = floor(scale * component)``.

    Rows with a null id, label or vector, or any null or non-finite component, take no part.  A vector's
    id names it: of rows that share one, the smallest by label and vector takes part, so repeated rows count once.
    Components beyond 2 ** 28 are held there.
    """
    prepared(embeddings.sparkSession)
    x = F.transform("embedding", lambda c: c.cast("double"))
    rows = embeddings.select(embeddings["vec_id"].cast("long").alias("vec_id"), embeddings["label"].cast("long").alias("label"), embeddings["embedding"])
    known = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull()
    good = rows.where(known).withColumn("x", x).where(F.forall("x", lambda c: c.isNotNull() & (F.abs(c) < F.lit(float("inf")))))
    whole = F.transform("x", lambda c: F.floor(F.greatest(F.lit(-LIMIT), F.least(F.lit(LIMIT), c * scale))).cast("long"))
    one = good.groupBy("vec_id").agg(F.min(F.struct("label", whole.alias("x"))).alias("r"))
    return one.select("vec_id", "r.label", "r.x")


class Block:
    """Rows with a sorted list for each dimension."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, x: np.ndarray):
        self.ids, self.labels, self.x = ids, labels, x
        self.order = np.ascontiguousarray(np.argsort(x, axis=0, kind="stable").T)
        self.sorted = np.take_along_axis(x.T, self.order, axis=1)
        self.most = int(np.abs(x).max(initial=0))
        self.real = x.astype(np.float32)

    def scores(self, rows: np.ndarray, anchor: np.ndarray) -> np.ndarray:
        """Random access: exact inner products (in floating point only where no sum can be rounded)."""
        if self.most * int(np.abs(anchor).sum()) < 1 << 24:
            return (self.real[rows] @ anchor.astype(np.float32)).astype(np.int64)
        return self.x[rows] @ anchor

    def sorted_access(self, anchor: np.ndarray, depth: int) -> Iterator[tuple[np.ndarray, np.ndarray, int | None]]:
        """New rows, their scores and the threshold (None: all rows were seen), deeper each time."""
        count, dims = len(self.ids), self.x.shape[1]
        falling, rising = np.flatnonzero(anchor > 0), np.flatnonzero(anchor < 0)
        if not len(falling) and not len(rising):
            falling = np.arange(min(1, dims))  # every score is 0: any list reaches all rows
        seen, at = np.zeros(count, bool), 0
        while at < count:
            to = min(count, at + depth)
            fresh = np.zeros(count, bool)
            fresh[self.order[falling, count - to : count - at].ravel()] = True
            fresh[self.order[rising, at:to].ravel()] = True
            fresh &= ~seen
            seen |= fresh
            rows = np.flatnonzero(fresh)
            below = int(anchor[falling] @ self.sorted[falling, count - to]) + int(anchor[rising] @ self.sorted[rising, to - 1])
            yield rows, self.scores(rows, anchor), None if seen.all() else below
            if seen.all():
                return
            at, depth = to, 2 * depth


class Best:
    """The first ``k`` of the scores within a window: higher scores first, ties by smaller id."""

    def __init__(self, k: int, low: int | None = None, high: int | None = None):
        self.k, self.low, self.high = k, low, high
        self.ids, self.scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.done = low is not None and high < low

    def offer(self, ids: np.ndarray, scores: np.ndarray, threshold: int | None) -> None:
        inside = np.ones(len(scores), bool) if self.high is None else scores <= self.high
        if len(self.ids) == self.k:
            inside &= scores >= self.scores.min()
        elif self.low is not None:
            inside &= scores >= self.low
        ids, scores = np.concatenate([self.ids, ids[inside]]), np.concatenate([self.scores, scores[inside]])
        if len(ids) > self.k:
            near = scores >= np.partition(scores, -self.k)[-self.k]
            ids, scores = ids[near], scores[near]
            first = np.lexsort((ids, -scores))[: self.k]
            ids, scores = ids[first], scores[first]
        self.ids, self.scores = ids, scores
        full = threshold is not None and len(ids) >= self.k and threshold < int(scores.min())
        self.done = threshold is None or full or (self.low is not None and threshold < self.low)


def search(block: Block, anchor: np.ndarray, allowed: np.ndarray, windows: list[Best], depth: int) -> int:
    """Fill the windows from the allowed rows of a block; how many rows were scored."""
    scored = 0
    if all(w.done for w in windows) or not len(block.ids):
        return scored
    for rows, scores, threshold in block.sorted_access(anchor, depth):
        scored += len(rows)
        of_use = allowed[rows]
        ids, scores = block.ids[rows][of_use], scores[of_use]
        for window in windows:
            if not window.done:
                window.offer(ids, scores, threshold)
        if all(w.done for w in windows):
            break
    return scored


def window_of(score: int, how: Mining) -> Best:
    """The scores ``s`` with ``low * score <= 100 * s <= high * score``."""
    return Best(how.negatives, -(-how.low * score // 100), how.high * score // 100)


def _matrix(column: pa.ListArray) -> np.ndarray:
    """Vectors as rows; shorter ones end in zeros."""
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    dims = max(1, int(lengths.max(initial=0)))
    if (lengths == dims).all():
        return flat.reshape(len(lengths), dims)
    out = np.zeros((len(lengths), dims), np.int64)
    out[np.arange(dims)[None, :] < lengths[:, None]] = flat
    return out


def _fitted(x: np.ndarray, dims: int) -> np.ndarray:
    return np.pad(x[..., :dims], [(0, 0)] * (x.ndim - 1) + [(0, max(0, dims - x.shape[-1]))])


def _stacked(parts: list[tuple]) -> Block:
    dims = max(p[2].shape[1] for p in parts)
    return Block(*[np.concatenate([p[k] for p in parts]) for k in (0, 1)], np.concatenate([_fitted(p[2], dims) for p in parts]))


def _searched(batches: Iterator[pa.RecordBatch], how: Mining, negatives: bool) -> Iterator[pa.RecordBatch]:
    """Rows of a block come before the anchors it is asked for; one block is held at a time."""
    number, parts, block = None, [], None
    schema = pa.schema([(n, pa.int64()) for n in ("anchor_id", "positive_id", "positive_score", "id", "score")])
    for batch in batches:
        blocks, asked = (batch.column(c).to_numpy() for c in ("block", "asked"))
        ids, labels = (batch.column(c).to_numpy() for c in ("vec_id", "label"))
        edges = np.flatnonzero(np.diff(blocks) | np.diff(asked)) + 1
        out = []
        for start, end in zip([0, *edges], [*edges, len(blocks)], strict=True):
            if blocks[start] != number:
                number, parts, block = blocks[start], [], None
            x = _matrix(batch.column("x").slice(start, end - start))
            if not asked[start]:
                parts.append((ids[start:end].copy(), labels[start:end].copy(), x))
                continue
            if not parts:
                continue  # a block without rows
            block = block or _stacked(parts)
            wanted = batch.column("wanted").slice(start, end - start).to_pylist()
            for anchor_id, label, vector, positives in zip(ids[start:end].tolist(), labels[start:end], x, wanted, strict=True):
                vector = _fitted(vector, block.x.shape[1])
                if negatives:
                    windows, allowed = [window_of(p["score"], how) for p in positives], block.labels != label
                else:
                    windows, allowed = [Best(how.positives)], (block.labels == label) & (block.ids != anchor_id)
                search(block, vector, allowed, windows, how.first_depth)
                for positive, found in zip(positives or [{"id": 0, "score": 0}], windows, strict=True):
                    out += [(anchor_id, positive["id"], positive["score"], i, s) for i, s in zip(found.ids.tolist(), found.scores.tolist(), strict=True)]
        columns = list(zip(*out, strict=True)) or [()] * 5
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], schema=schema)


def _against_all(rows: DataFrame, anchors: DataFrame, blocks: int, how: Mining, negatives: bool) -> DataFrame:
    """What every block finds for every anchor; anchors carry ``wanted``, their positives so far."""
    everywhere = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block")
    asked = anchors.select(everywhere, F.lit(1).alias("asked"), "vec_id", "label", "x", "wanted")
    none = F.array().cast("array<struct<id:long,score:long>>").alias("wanted")
    both = rows.select("block", F.lit(0).alias("asked"), "vec_id", "label", "x", none).union(asked)
    dealt = both.repartitionByRange(blocks, "block").sortWithinPartitions("block", "asked", "vec_id")
    return dealt.mapInArrow(partial(_searched, how=how, negatives=negatives), FOUND)


def _first(found: DataFrame, k: int, *group: str) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(*group).orderBy(F.desc("score"), "id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k)


def mine(rows: DataFrame, is_anchor, how: Mining = DEFAULT) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` (see ``Mining``).

    ``rows`` has ``vec_id, label, x`` (``integer_rows``), ``is_anchor`` is a condition on them.  Positives are the best
    other rows of an anchor's label, negatives the best rows of other labels inside the window of a
    positive; ties go to the smaller id.  Anchors without positives, and positives with no row in their
    window (negative scores have none), give no rows; neither does an empty table.  Shorter vectors
    count as if they ended in zeros.
    """
    spark = prepared(rows.sparkSession)
    rows = written(rows.select("vec_id", "label", "x"), "vectors")
    count, dims = rows.agg(F.count("*"), F.max(F.size("x"))).first()
    result = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    if not count:
        return spark.createDataFrame([], result)
    blocks = -(-count // max(1, how.block_values // max(1, dims)))
    placed = rows.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int"))
    none = F.array().cast("array<struct<id:long,score:long>>")
    anchors = rows.where(is_anchor)
    found = _against_all(placed, anchors.withColumn("wanted", none), blocks, how, negatives=False)
    best = _first(written(found, "positives"), how.positives, "anchor_id")
    wanted = best.groupBy("anchor_id").agg(F.collect_list(F.struct("id", "score")).alias("wanted"))  # how.positives at most
    asked = written(anchors.join(wanted, anchors["vec_id"] == wanted["anchor_id"]).select("vec_id", "label", "x", "wanted"), "anchors")
    found = _against_all(placed, asked, blocks, how, negatives=True)
    best = _first(written(found, "negatives"), how.negatives, "anchor_id", "positive_id")
    return best.select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
