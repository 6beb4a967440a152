"""JSON source documents: ``{metadata, clauses[]}``, one per file."""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from functools import partial

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from attestra.functions.binding import bind
from attestra.functions.json_values import run_id
from attestra.session import reachable
from attestra.sources.splitting import pieces

RECORDS_FIELD = "clauses"
BATCH_BYTES = 4 << 20  # of record texts that leave the splitter at once
LARGE = 1 << 24  # bytes; a valid record that is no VARIANT is too large if it has more, else it repeats a field

# What the splitter adds to the columns of a document.  The head row of a document (no index, no reason)
# stands for the document itself.
SPLIT = {
    "source": ("string", pa.string()),
    "source_api_version": ("string", pa.string()),
    "source_metadata": ("string", pa.string()),
    "records_in_source": ("bigint", pa.int64()),
    "record_index": ("bigint", pa.int64()),
    "byte_offset": ("bigint", pa.int64()),
    "bytes": ("bigint", pa.int64()),
    "payload": ("string", pa.string()),
    "raw": ("binary", pa.binary()),
    "reason": ("string", pa.string()),
}


def snapshot_sources(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """The exact bytes of every source file with their SHA-256 and the run id they define."""
    return snapshot(spark.read.format("binaryFile").load(paths))


def snapshot(files: DataFrame) -> DataFrame:
    """The same for any (also streaming) ``binaryFile`` rows."""
    digest = F.sha2(F.col("content"), 256)
    return files.select(
        F.col("path"),
        F.element_at(F.split("path", "/"), -1).alias("source_file"),
        digest.alias("source_sha256"),
        run_id(F.col("path"), digest).alias("run_id"),
        F.col("length"),
        F.col("content"),
    )


def _told(metadata: str | None, field: str) -> str:
    """A text field of the metadata; other values as JSON, ``unknown`` where it says nothing."""
    try:
        value = json.loads(metadata or "{}")[field]
    except (ValueError, KeyError, TypeError):
        return "unknown"
    if value is None:
        return "unknown"
    return value if isinstance(value, str) else json.dumps(value)


def _rows(content: bytes, records_field: str) -> Iterator[tuple]:
    """The head row of a document and its pieces, in the order of ``SPLIT``."""
    text = content.decode("utf-8", "surrogateescape")
    metadata, found = pieces(text, records_field)
    exact = len(text) == len(content)
    about = _clean(metadata)
    source, version = _told(about, "source"), _told(about, "api_version")
    count = sum(p.index is not None for p in found)
    yield source, version, about, count, None, None, None, None, None, None
    at = offset = 0
    for piece in found:
        offset = piece.start if exact else offset + _size(text[at : piece.start])
        at = piece.start
        part = text[piece.start : piece.end]
        good = _clean(part)
        raw = part.encode("utf-8", "surrogateescape") if good is None or piece.reason else None
        size = len(part) if exact else _size(part)
        reason = piece.reason or ("invalid_utf8" if good is None else None)
        yield source, version, None, count, piece.index, offset, size, None if reason else good, raw, reason


def _size(text: str) -> int:
    return len(text.encode("utf-8", "surrogateescape"))


def _clean(text: str | None) -> str | None:
    """The text, or None if it stands for bytes that are no UTF-8."""
    try:
        if text is not None:
            text.encode("utf-8")
        return text
    except UnicodeEncodeError:
        return None


def _split(batches: Iterator[pa.RecordBatch], records_field: str) -> Iterator[pa.RecordBatch]:
    kinds = [kind for _, kind in SPLIT.values()]
    for batch in batches:
        keys = [n for n in batch.schema.names if n != "content"]
        where, rows, size = [], [], 0

        def out() -> pa.RecordBatch:
            own = [batch.column(k).take(pa.array(where, pa.int64())) for k in keys]
            made = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)]
            return pa.RecordBatch.from_arrays(own + made, [*keys, *SPLIT])

        for k, content in enumerate(batch.column("content")):
            for row in _rows(content.as_py() or b"", records_field):
                where.append(k)
                rows.append(row)
                size += 64 + (row[6] or 0)
                if size >= BATCH_BYTES:
                    yield out()
                    where, rows, size = [], [], 0
        if rows:
            yield out()


def split_documents(documents: DataFrame, keys: Sequence[str], records_field: str = RECORDS_FIELD) -> DataFrame:
    """One row per record of ``documents`` (``keys..., content`` binary), and a head row per document.

    ``payload`` is the record's exact text and ``byte_offset, bytes`` its place.  What cannot be a record has a
    ``reason`` and its bytes in ``raw``; parts that belong to no record have no index.  No document fails
    the others, whatever it holds; null content is an empty document.
    """
    reachable(documents.sparkSession)
    asked = documents.select(*keys, "content")
    own = [f"`{f.name}` {f.dataType.simpleString()}" for f in asked.schema if f.name != "content"]
    ddl = ", ".join([*own, *[f"`{n}` {kind}" for n, (kind, _) in SPLIT.items()]])
    return asked.mapInArrow(partial(_split, records_field=records_field), ddl)


def _outcome(canonical: Column, payload: Column) -> Column:
    """``record_hash`` and ``reason`` of a payload from its canonical form (null: it is no VARIANT)."""
    valid = F.from_json(payload, "map<string,string>", {"maxStringLen": str(2**31 - 1)}).isNotNull()
    no_variant = F.when(~valid, "malformed_record").when(F.octet_length(payload) > LARGE, "too_large").otherwise("duplicate_fields")
    return F.struct(
        F.concat(F.lit("sha256:"), F.sha2(canonical, 256)).alias("record_hash"),
        F.when(canonical.isNull(), no_variant).when(~canonical.startswith("{"), "not_an_object").alias("reason"),
    )


def checked_records(split: DataFrame) -> DataFrame:
    """Add ``record_hash`` and complete ``reason``: a record without a reason is a JSON object that every step can read.

    ``malformed_record``: no JSON; ``duplicate_fields``: an object names a field twice; ``too_large``: beyond what a
    VARIANT holds (128 MiB); ``not_an_object``.  Each payload is parsed once.
    """
    canonical = F.to_json(F.try_parse_json("payload"))
    outcome = F.when(F.col("payload").isNotNull(), bind(canonical, lambda c: _outcome(c, F.col("payload"))))
    out = split.withColumn("_outcome", outcome)
    reason = F.coalesce("reason", "_outcome.reason")
    return out.select(
        *[c for c in split.columns if c not in ("payload", "raw", "reason")],
        "payload",
        F.when(reason.isNotNull(), F.coalesce("raw", F.col("payload").cast("binary"))).alias("raw"),
        F.when(reason.isNull(), F.col("_outcome.record_hash")).alias("record_hash"),
        reason.alias("reason"),
    )


def records_only(split: DataFrame) -> DataFrame:
    """The rows that are records without a reason to reject them."""
    return split.where(F.col("record_index").isNotNull() & F.col("reason").isNull()).drop("source_metadata", "raw", "reason")


def read_documents(spark: SparkSession, paths: str | list[str], records_field: str = RECORDS_FIELD) -> DataFrame:
    """Records of every document under ``paths`` with file, digest, run id and outcome."""
    files = snapshot_sources(spark, paths)
    return checked_records(split_documents(files, ("source_file", "source_sha256", "run_id"), records_field))
