"""Sharding by sampled splitters: shards of near-equal bytes that are ranges of one key order.

The key is (hash of the text, ``doc_id``), so equal texts are neighbours and a group of copies larger
than a range is divided by ``doc_id``.  A size-weighted sample gives quantile boundaries; ranges that
turn out overfull are sampled again and subdivided.  Exact sums of the ranges then place every record.
DataFrame and SQL functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from attestra.llm.common import own_columns, prepared, written

RANGES = 512
SAMPLES = 16  # expected sample rows for each range
ROUNDS = 4
LOWEST = -(1 << 63)

Splitter = tuple[int, int]


def _key() -> Column:
    return F.struct(F.col("h"), F.col("id"))


def _place(splitters: list[Splitter]) -> Column:
    """Number of splitters at or below the key, found in two steps of about the square root of their number."""
    if not splitters:
        return F.lit(0)
    step = max(1, round(len(splitters) ** 0.5))
    groups = [splitters[at : at + step] for at in range(0, len(splitters), step)]

    def literal(keys: list[Splitter]) -> Column:
        return F.array(*[F.struct(F.lit(h).cast("long").alias("h"), F.lit(i).cast("long").alias("id")) for h, i in keys])

    def at_or_below(keys: Column) -> Column:
        return F.size(F.filter(keys, lambda k: k <= _key()))

    group = F.greatest(at_or_below(literal([g[0] for g in groups])) - 1, F.lit(0))
    inside = at_or_below(F.element_at(F.array(*[literal(g) for g in groups]), group + 1))
    return (group * step + inside).cast("int")


def _quantiles(rows: DataFrame, target: float) -> list[Splitter]:
    """Boundaries that cut each ``part`` of ``rows`` (``h, id, bytes, part``) into pieces of about ``target`` bytes.

    A row is drawn with a probability proportional to its bytes, by a hash, so a retry draws the same.
    About ``SAMPLES`` rows for each piece are drawn, and a row that is larger than a draw counts as many.
    """
    per_draw = target / SAMPLES
    uniform = F.shiftrightunsigned(F.xxhash64("h", "id", F.lit("draw")), 11) / F.lit(float(1 << 53))
    drawn = rows.where(uniform * per_draw < F.col("bytes"))
    drawn = drawn.withColumn("weight", F.greatest(F.lit(1.0), F.col("bytes") / per_draw))
    order = Window.partitionBy("part").orderBy("h", "id")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    piece = F.floor(F.coalesce(F.sum("weight").over(before), F.lit(0.0)) / SAMPLES)
    cut = drawn.withColumn("piece", piece).withColumn("last", F.lag("piece").over(order))
    chosen = cut.where("piece > last").select("h", "id").distinct()
    return [(r.h, r.id) for r in chosen.collect()]  # one for each piece at most, 2 * RANGES over all rounds


def splitters_of(rows: DataFrame, total: int) -> list[Splitter]:
    """Sorted boundaries of about ``RANGES`` ranges of equal bytes; overfull ranges are subdivided."""
    target = total / RANGES
    splitters = sorted(_quantiles(rows.withColumn("part", F.lit(0)), target))
    for _ in range(ROUNDS):
        placed = rows.withColumn("part", _place(splitters))
        sums = placed.groupBy("part").agg(F.sum("bytes").alias("b"), F.min(_key()).alias("lo"), F.max(_key()).alias("hi"))
        overfull = [r.part for r in sums.where((F.col("b") > 2 * target) & (F.col("lo") < F.col("hi"))).collect()]
        if not overfull:
            break
        more = _quantiles(placed.where(F.col("part").isin(overfull)), target)
        if not set(more) - set(splitters):
            break
        splitters = sorted({*splitters, *more})
    return splitters


def shard(docs: DataFrame, shards: int = 24) -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot`` for every row of ``docs`` (``doc_id, text``).

    ``size`` is the UTF-8 bytes of the text (null: none) plus 8.  In key order, a record goes to the
    shard in which the middle of its bytes lies, so a shard's bytes differ from the mean by less than
    its two outermost records.  ``slot`` numbers a shard's records from 0.  Records that agree in id and
    text are placed as one entry with a count and unfolded at the end; null ids come first; an empty
    table gives no rows.
    """
    prepared(docs.sparkSession)
    text = F.coalesce("text", F.lit(""))
    rows = own_columns(docs, "doc_id", "text").select(
        "doc_id",
        F.xxhash64(text).alias("h"),
        F.coalesce("doc_id", F.lit(LOWEST)).alias("id"),
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    rows = written(rows.groupBy("doc_id", "h", "id", "size", "text_crc32").agg(F.count("*").alias("n")), "sizes")
    rows = rows.withColumn("bytes", F.col("size") * F.col("n"))
    total = rows.agg(F.sum("bytes")).first()[0] or 0

    placed = rows.withColumn("part", _place(splitters_of(rows, total)))
    # One row a range, 2 * RANGES at most.
    ranges = placed.groupBy("part").agg(F.sum("bytes").alias("b"), F.sum("n").alias("k"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranges.select(
        "part", F.coalesce(F.sum("b").over(earlier), F.lit(0)).alias("b0"), F.coalesce(F.sum("k").over(earlier), F.lit(0)).alias("k0")
    )
    inside = Window.partitionBy("part").orderBy("h", "id", "size", "text_crc32", F.col("doc_id").asc_nulls_first())
    before = inside.rowsBetween(Window.unboundedPreceding, -1)
    entries = (
        placed.withColumn("b1", F.coalesce(F.sum("bytes").over(before), F.lit(0)))
        .withColumn("k1", F.coalesce(F.sum("n").over(before), F.lit(0)))
        .join(F.broadcast(offsets), "part")
    )
    copy = F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1))
    records = entries.withColumn("copy", copy).select(
        "doc_id",
        "size",
        "text_crc32",
        (F.col("b0") + F.col("b1") + F.col("copy") * F.col("size")).alias("start"),
        (F.col("k0") + F.col("k1") + F.col("copy")).alias("place"),
    )
    middle = F.expr(f"((2 * start + size) * {int(shards)}) div {max(1, 2 * total)}")
    records = written(records.withColumn("shard", F.least(middle, F.lit(shards - 1)).cast("int")), "records")
    firsts = records.groupBy("shard").agg(F.min("place").alias("first"))  # one row a shard
    return records.join(F.broadcast(firsts), "shard").select(
        "doc_id", "size", "text_crc32", "shard", (F.col("place") - F.col("first")).alias("slot")
    )
