"""Token counts of whole texts; huge texts are encoded in overlapping chunks and spliced.

A chunk's encoding is right away from its artificial ends only.  Two neighbours are spliced at a
boundary inside their overlap that is proven stable: both encodings start a token there, the character
before it is visible, the one at it is white space (no token of these tokenizers spans such a place, so
the encodings of both sides cannot depend on each other), and the tokens from there to the next such
place agree.  Where an overlap holds no such place, the text is encoded again with a wider one, until
the overlap is the text.
"""

from __future__ import annotations

import bisect
import hashlib
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from attestra.llm.common import own_columns, prepared, written
from attestra.llm.encoding import UNSURE, encoder

CHUNK = 1 << 14
OVERLAP = 1 << 8
WIDEN = 8

ROWS = pa.schema(
    [("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64()), ("key", pa.binary()), ("text", pa.string())]
)
SUMMARY = pa.schema(
    [("key", pa.binary()), ("start", pa.int64()), ("n_tokens", pa.int64())]
    + [(f"{side}_{what}", pa.list_(pa.int64())) for side in ("head", "tail") for what in ("at", "before", "next")]
)


def stable(text: str, offsets: list[tuple[int, int]], ids: list[int], start: int, lo: int, hi: int) -> list[tuple[int, int, int]]:
    """Stable boundaries in ``text[lo:hi]``: place in the document, tokens before it, a digest of what follows.

    ``start`` is the place of ``text`` in the document.  The digest covers the tokens up to the next
    stable boundary and their offsets; a boundary that has none after it in the range is left out.
    """
    first = bisect.bisect_left(offsets, (lo, 0))
    places = []
    for k in range(first, len(offsets)):
        at = offsets[k][0]
        if at > hi:
            break
        if 0 < at < len(text) and text[at].isspace() and not text[at - 1].isspace() and text[at] not in UNSURE:
            if not places or places[-1][0] != at:
                places.append((at, k))
    out = []
    for (at, k), (_, end) in zip(places, places[1:], strict=False):
        told = repr([(ids[j], offsets[j][0] + start, offsets[j][1] + start) for j in range(k, end)]).encode()
        digest = int.from_bytes(hashlib.blake2b(told, digest_size=8).digest(), "little", signed=True)
        out.append((start + at, k, digest))
    return out


def _encode_short(batches: Iterator[pa.RecordBatch], path: str, chunk: int) -> Iterator[pa.RecordBatch]:
    """Counts of ordinary texts; huge ones leave their hash here and their text for the chunks."""
    encode = encoder(path)
    for batch in batches:
        texts = [t or "" for t in batch.column("text").to_pylist()]
        found = encode.encode_batch([t if len(t) <= chunk else None for t in texts])
        rows = []
        for doc_id, text, ids in zip(batch.column("doc_id").to_pylist(), texts, found, strict=True):
            raw = text.encode()
            if len(text) <= chunk:
                rows.append((doc_id, len(raw), len(ids) // 4, None, None))
            else:
                rows.append((doc_id, len(raw), None, hashlib.sha256(raw).digest(), text))
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), ROWS, strict=True)], schema=ROWS
            )


def _encode_chunks(batches: Iterator[pa.RecordBatch], path: str, overlap: int) -> Iterator[pa.RecordBatch]:
    tokenizer = encoder(path).tokenizer
    for batch in batches:
        columns = [batch.column(n).to_pylist() for n in ("key", "start", "length", "text")]
        for row in range(0, batch.num_rows, 8):
            part = [c[row : row + 8] for c in columns]
            out = []
            found = tokenizer.encode_batch(part[3], add_special_tokens=False)
            for key, start, length, text, encoding in zip(*part, found, strict=True):
                offsets, ids = encoding.offsets, encoding.ids
                head = stable(text, offsets, ids, start, 0, overlap) if start else []
                last = start + len(text) == length
                tail = [] if last else stable(text, offsets, ids, start, len(text) - overlap, len(text))
                sides = [[x[k] for x in side] for side in (head, tail) for k in range(3)]
                out.append((key, start, len(ids), *sides))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), SUMMARY, strict=True)], schema=SUMMARY
            )


def _splice(chunks: DataFrame) -> DataFrame:
    """``key, n_tokens`` of each text; null where two neighbours have no common stable boundary."""

    def paired(side: str):
        return F.arrays_zip(*[F.col(f"{side}_{w}").alias(w) for w in ("at", "before", "next")])

    order = Window.partitionBy("key").orderBy("start")
    rows = chunks.select("key", "start", "n_tokens", paired("head").alias("head"), paired("tail").alias("tail"))
    rows = rows.withColumn("left", F.lag("tail").over(order))
    # Both ends of a splice agree on its place and on the digest; take the first such pair.
    match = F.filter(
        "left",
        lambda l: F.exists("head", lambda h: (h["at"] == l["at"]) & (h["next"] == l["next"])),
    )
    cut = F.get(match, F.lit(0))
    mine = F.get(F.filter("head", lambda h: h["at"] == cut["at"]), F.lit(0))
    first = F.col("left").isNull()
    spliced = rows.withColumn("lost", ~first & cut.isNull()).withColumn(
        "change", F.when(first, F.lit(0)).otherwise(cut["before"] - mine["before"])
    )
    # Tokens of a chunk before the splice belong to its left neighbour, whose tokens behind it are dropped:
    # sum over chunks of all tokens, less (tokens of the left behind the splice + own before the splice).
    spliced = spliced.withColumn("left_tokens", F.lag("n_tokens").over(order))
    kept = F.when(first, F.col("n_tokens")).otherwise(F.col("n_tokens") - F.col("left_tokens") + F.col("change"))
    total = spliced.groupBy("key").agg(F.sum(kept).alias("n_tokens"), F.max("lost").alias("lost"))
    return total.select("key", F.when(~F.col("lost"), F.col("n_tokens")).alias("n_tokens"))


def count_huge(texts: DataFrame, path: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """``key, n_tokens`` of distinct texts (``key, text``), by chunks that are dealt out to all tasks."""
    done: DataFrame | None = None
    while True:
        length = F.length("text").cast("long")
        step = max(1, chunk - overlap) if overlap < chunk else chunk
        wide = step + overlap
        starts = F.sequence(F.lit(0).cast("long"), F.greatest(length - overlap - 1, F.lit(0).cast("long")), F.lit(step).cast("long"))
        cut = texts.select("key", length.alias("length"), "text", F.explode(starts).alias("start"))
        cut = cut.select("key", "start", "length", F.expr(f"substring(text, cast(start as int) + 1, {wide})").alias("text"))
        cut = cut.repartition("key", "start")
        names = {f.name: str(f.type) for f in SUMMARY}
        kinds = {"binary": "binary", "int64": "long"}
        schema = ", ".join(f"{n} {kinds.get(t, 'array<long>')}" for n, t in names.items())
        counts = written(_splice(cut.mapInArrow(partial(_encode_chunks, path=path, overlap=overlap), schema)), "spliced")
        found = counts.where("n_tokens is not null")
        done = found if done is None else done.union(found)
        rest = counts.where("n_tokens is null").select("key")
        if rest.isEmpty():
            return done
        texts = texts.join(rest, "key", "left_semi")
        overlap *= WIDEN


def count_tokens(docs: DataFrame, path: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """``doc_id, n_bytes, n_tokens`` of every row of ``docs`` (``doc_id, text``).

    Counts are those of the library for the whole text, special strings included.  Null and empty texts
    have no tokens; repeated rows are counted each; an empty table gives no rows.  Equal huge texts are
    encoded once.  The tokenizer splits words before it encodes them and keeps white space apart from
    what stands before it.
    """
    prepared(docs.sparkSession)
    rows = own_columns(docs, "doc_id", "text").mapInArrow(
        partial(_encode_short, path=path, chunk=chunk), "doc_id long, n_bytes long, n_tokens long, key binary, text string"
    )
    rows = written(rows, "counts")
    short = rows.where("key is null").select("doc_id", "n_bytes", "n_tokens")
    huge = rows.where("key is not null")
    if huge.isEmpty():
        return short
    texts = written(huge.groupBy("key").agg(F.first("text").alias("text")), "huge")
    counts = count_huge(texts, path, chunk, overlap)
    return short.union(huge.select("doc_id", "n_bytes", "key").join(counts, "key").select("doc_id", "n_bytes", "n_tokens"))
