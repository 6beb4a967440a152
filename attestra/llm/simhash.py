"""SimHash near-duplicates: 64-bit fingerprints of word shingles, linked when few bits differ.

Distinct fingerprints are laid out in tiles by the population counts of their four 16-bit quarters.
Two fingerprints at distance ``d`` have quarter counts that differ by ``d`` in all at most, so a pair
of tiles whose counts are further apart than the radius holds no link and is skipped.  All other pairs
are compared whole, in blocks of bounded size, by exclusive-or and bit counts in numpy.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attestra.llm.common import own_columns, prepared, small_side, written
from attestra.llm.components import components
from attestra.llm.encoding import release

SEED = 42
QUARTERS = 4
BLOCK = 4096  # fingerprints of a tile that are compared at once
CELLS = 1 << 20  # entries of one comparison matrix


def fingerprint(text: str | None, shingle: int = 3, seed: int = SEED) -> int:
    """Unsigned 64-bit fingerprint; no words (or null) give zero."""
    words = (text or "").encode().lower().split()  # bytes: A-Z only, ASCII white space only
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    width = min(shingle, len(words))
    first, last = starts[: len(words) - width + 1].tolist(), ends[width - 1 :].tolist()
    counts = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, len(first), 1 << 16):
        part = zip(first[at : at + (1 << 16)], last[at : at + (1 << 16)], strict=True)
        hashes = np.array([digest(joined[s:e], seed) for s, e in part], dtype="<u8")
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(first), bitorder="little").view("<u8")[0])


def _fingerprints(batches: Iterator[pa.RecordBatch], shingle: int, seed: int) -> Iterator[pa.RecordBatch]:
    release()
    for batch in batches:
        found = np.array([fingerprint(t, shingle, seed) for t in batch.column("text").to_pylist()], dtype="<u8")
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("row_key"), pa.array(found.view("<i8"))], ["doc_id", "row_key", "fp"]
        )


def fingerprints(docs: DataFrame, shingle: int = 3, seed: int = SEED) -> DataFrame:
    """``doc_id, row_key, fp``, written; ``row_key`` is a hash of the text, equal for equal texts."""
    prepared(docs.sparkSession)
    rows = own_columns(docs, "doc_id", "text").withColumn("row_key", F.xxhash64(F.coalesce("text", F.lit(""))))
    made = rows.mapInArrow(partial(_fingerprints, shingle=shingle, seed=seed), "doc_id long, row_key long, fp long")
    return written(made, "fingerprints")


def _forest(nodes: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Edges that connect exactly what links within ``radius`` connect among ``nodes``, one less than nodes at most."""
    rest, edges = np.unique(nodes), []
    while len(rest):
        reached, rest = [rest[0]], rest[1:]
        while reached and len(rest):
            node = reached.pop()
            near = np.bitwise_count(rest ^ node) <= radius
            if near.any():
                found = rest[near]
                edges.extend((int(node), int(x)) for x in found)
                reached.extend(found)
                rest = rest[~near]
    return edges


def links(a: np.ndarray, b: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Links between two blocks; when they are denser than a forest, a forest that connects the same."""
    edges: list[tuple[int, int]] = []
    rows = max(1, CELLS // max(1, len(b)))
    for at in range(0, len(a), rows):
        near = np.bitwise_count(a[at : at + rows, None] ^ b[None, :]) <= radius
        i, j = np.nonzero(near)
        if len(i):
            x, y = a[at + i], b[j]
            other = x != y
            edges.extend(zip(x[other].tolist(), y[other].tolist(), strict=True))
            if len(edges) > 2 * (len(a) + len(b)):
                return _forest(np.concatenate([a, b]), radius)
    return edges


def _compare(batches: Iterator[pa.RecordBatch], radius: int) -> Iterator[pa.RecordBatch]:
    def whole(column: pa.Array, row: int) -> np.ndarray:
        return column[row].values.to_numpy(zero_copy_only=False).view("<u8")

    for batch in batches:
        a, b = batch.column("a"), batch.column("b")
        edges = [e for row in range(batch.num_rows) for e in links(whole(a, row), whole(b, row), radius)]
        ends = np.array(edges, dtype="<u8").reshape(-1, 2).view("<i8")
        yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(ends[:, k])) for k in (0, 1)], ["u", "v"])


def _neighbours(radius: int) -> list[tuple[int, ...]]:
    """Differences of quarter counts within ``radius``, one of each opposite pair."""
    steps = product(range(-radius, radius + 1), repeat=QUARTERS)
    return [s for s in steps if sum(map(abs, s)) <= radius and s >= (0,) * QUARTERS]


def _quarter(fp: Column, k: int) -> Column:
    return F.bit_count(F.shiftrightunsigned(fp, 16 * k).bitwiseAND(F.lit(0xFFFF)))


def near_links(distinct: DataFrame, radius: int) -> DataFrame:
    """Edges ``u, v`` between distinct fingerprints (column ``fp``) that connect all links within ``radius``."""
    names = [f"q{k}" for k in range(QUARTERS)]
    tiled = distinct.select("fp", *[_quarter(F.col("fp"), k).alias(n) for k, n in enumerate(names)])
    # A tile is four counts of 0 to 16: 83,521 tiles at most, whatever the input.
    tiles = tiled.groupBy(*names).agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    placed = tiled.join(F.broadcast(tiles), names).withColumn("block", F.pmod(F.xxhash64("fp"), "blocks").cast("int"))
    blocks = placed.groupBy(*names, "block").agg(F.collect_list("fp").alias("fps"))

    steps = F.array(*[F.struct(*[F.lit(d).alias(n) for n, d in zip(names, s, strict=True)]) for s in _neighbours(radius)])
    here = tiles.select(*names, "blocks", F.explode(steps).alias("step"))
    here = here.select(
        *[F.col(n).alias(f"a_{n}") for n in names], F.col("blocks").alias("a_blocks"), *[(F.col(n) + F.col(f"step.{n}")).alias(n) for n in names]
    )
    pairs = here.join(F.broadcast(tiles.withColumnRenamed("blocks", "b_blocks")), names)
    same = F.lit(True)
    for n in names:
        same = same & (F.col(f"a_{n}") == F.col(n))
    pairs = pairs.withColumn("a_block", F.explode(F.sequence(F.lit(0), F.col("a_blocks") - 1)))
    pairs = pairs.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("b_blocks") - 1)))
    pairs = pairs.where(~same | (F.col("a_block") <= F.col("block"))).drop("a_blocks", "b_blocks")

    a = blocks.select(*[F.col(n).alias(f"a_{n}") for n in names], F.col("block").alias("a_block"), F.col("fps").alias("a"))
    b = blocks.withColumnRenamed("fps", "b")
    both = pairs.join(a, [f"a_{n}" for n in names] + ["a_block"]).join(b, [*names, "block"]).select("a", "b")
    return both.mapInArrow(partial(_compare, radius=radius), "u long, v long")


def near_duplicates(docs: DataFrame, radius: int = 2, shingle: int = 3, seed: int = SEED) -> DataFrame:
    """``doc_id, row_key, fp, component_id`` for every row of ``docs`` (``doc_id, text``).

    Fingerprints are linked when ``radius`` bits or fewer differ; ``component_id`` is the smallest
    ``doc_id`` that links reach, the row's own included.  Null and empty texts have fingerprint zero and
    are linked like any other.  Repeated rows and equal fingerprints share a component.  A null
    ``doc_id`` never becomes a component's id unless the component has no other.  No rows give no rows.

    Equal fingerprints are collapsed before the comparison.  The number of compared pairs grows with the
    square of the distinct fingerprints, divided by what the tiles skip.
    """
    made = fingerprints(docs, shingle, seed)
    distinct = written(made.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct")
    roots = components(near_links(distinct, radius)).select(F.col("node").alias("fp"), "root")
    rooted = written(distinct.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp")), "rooted")
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    classes = rooted.join(least, "root").select("fp", "root", "component_id")
    return made.join(classes, "fp").select("doc_id", "row_key", "fp", "root", "component_id")


def one_of_each(docs: DataFrame, radius: int = 2, shingle: int = 3, seed: int = SEED) -> DataFrame:
    """``docs`` with its own columns and one row of each component, see ``first_of_each``."""
    return first_of_each(docs, written(near_duplicates(docs, radius, shingle, seed), "classes"))


def first_of_each(docs: DataFrame, found: DataFrame) -> DataFrame:
    """One row of each ``root`` of the written ``found`` (``doc_id, row_key, root``): the one with the smallest ``doc_id``.

    Ties are broken by a hash of the text; of rows that agree in both, any one stays.  A null ``doc_id``
    stays only where a component has no other.
    """
    place = F.struct(F.col("doc_id").isNull().alias("null"), "doc_id", "row_key")
    first = found.groupBy("root").agg(F.min(place).alias("first"))
    one = first.select(F.col("first.doc_id").alias("_id"), F.col("first.row_key").alias("_key"))
    rows = found.groupBy("doc_id", "row_key").agg(F.count("*").alias("n"))
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("row_key") == F.col("_key"))
    judged = written(rows.join(one, same, "left").select("doc_id", "row_key", "n", F.col("_key").isNotNull().alias("stays")), "judged")

    def listed(which: DataFrame) -> DataFrame:
        chosen = written(which.select(F.col("doc_id").alias("_id"), F.col("row_key").alias("_key")), "listed")
        return small_side(chosen, row_bytes=32)

    key = F.xxhash64(F.coalesce(docs["text"], F.lit("")))
    here = docs["doc_id"].eqNullSafe(F.col("_id")) & (key == F.col("_key"))
    repeated = judged.where("stays and n > 1")
    if repeated.isEmpty():
        return docs.join(listed(judged.where("not stays")), here, "left_anti")
    single = docs.join(listed(judged.where("not stays or n > 1")), here, "left_anti")
    many = docs.join(listed(repeated), here, "left_semi").withColumn("_key", key)
    return single.union(many.dropDuplicates(["doc_id", "_key"]).drop("_key"))
