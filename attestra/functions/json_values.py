"""Canonical JSON, record hashes, run ids and JSON type names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def canonical_json(payload: Column) -> Column:
    """Sorted keys, compact, UTF-8.  Text that is not valid JSON is kept as it is.

    VARIANT writes integral decimals without their point (``1.0`` -> ``1``); the form is
    stable, so equal payloads always give equal text.
    """
    return F.coalesce(F.to_json(F.try_parse_json(payload)), payload)


def sha256_hex(data: Column) -> Column:
    return F.sha2(data, 256)


def record_hash(payload: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(canonical_json(payload), 256))


def file_stem(path: Column) -> Column:
    """File name without folder and without its last extension."""
    name = F.element_at(F.split(path, "/"), -1)
    return F.regexp_replace(name, r"(?<=.)\.[^.]*$", "")


def run_id(path: Column, source_sha256: Column) -> Column:
    """``<stem>__<first 8 hex digits>``: derived from content, never from the clock."""
    return F.concat(file_stem(path), F.lit("__"), F.substring(source_sha256, 1, 8))


def ingest_date(ingested_at: Column) -> Column:
    return F.substring(ingested_at, 1, 10)


def utc_millis(ts: Column) -> Column:
    """RFC 3339 UTC text with milliseconds (the session time zone is UTC)."""
    return F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS"), F.lit("Z"))


def is_object(node: Column) -> Column:
    return F.schema_of_variant(node).startswith("OBJECT")


def type_name(variant_schema: Column) -> Column:
    """Map the text of ``schema_of_variant`` to null/bool/int/float/str/array/object.

    Integers beyond 64 bits come back as scale-0 decimals of 19 or more digits.
    """
    digits = F.regexp_extract(variant_schema, r"^DECIMAL\((\d+),0\)$", 1)
    return (
        F.when(variant_schema.isNull() | (variant_schema == "VOID"), "null")
        .when(variant_schema == "BOOLEAN", "bool")
        .when(variant_schema == "BIGINT", "int")
        .when((F.length(digits) == 2) & (digits >= "19"), "int")
        .when(variant_schema == "STRING", "str")
        .when(variant_schema.startswith("ARRAY"), "array")
        .when(variant_schema.startswith("OBJECT"), "object")
        .otherwise("float")
    )
