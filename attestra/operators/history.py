"""Versions of records with the time they were valid: nothing is lost, late versions find their place.

A version is a key, the time it holds from and a hash of its content.  Every version is kept; those that
only confirm the content before them are not ``changed``.  Changed versions hold from ``valid_from`` until
the next change of their key (``valid_to``, null for the current one), without gap or overlap.

A merge rewrites the keys that new versions touch and no others.  Their rows go into a new generation, and a
short list says which rows of earlier generations they replace; a generation counts once it is committed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from attestra.operators.ordering import RANGE, beside, with_range
from attestra.session import broadcast_if_small, cut_lineage, text_bytes


def content_hash(columns: Sequence[str]) -> Column:
    """Equal for equal content; nulls and absent fields are told apart from empty ones."""
    return F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256)


def versions(rows: DataFrame, key: str, valid_from: Column, content: Sequence[str], landed: Column) -> DataFrame:
    """One row per key and time, with ``valid_from``, ``change_hash`` and ``landed``.

    Of several rows for the same time the one landed last is the version (then the highest hash); rows
    without a key or a time are no versions.
    """
    every = rows.withColumns({"valid_from": valid_from, "change_hash": content_hash(content), "landed": landed})
    known = every.where(F.col(key).isNotNull() & F.col("valid_from").isNotNull())
    return _one_a_time(known, key)


def _one_a_time(rows: DataFrame, key: str) -> DataFrame:
    last = F.row_number().over(Window.partitionBy(key, "valid_from").orderBy(F.desc_nulls_last("landed"), F.desc("change_hash")))
    return rows.withColumn("_n", last).where(F.col("_n") == 1).drop("_n")


def intervals(rows: DataFrame, key: str, ranges: int | None = None) -> DataFrame:
    """Add ``changed`` and ``valid_to`` to versions (one per key and time)."""
    cut = with_range(rows.drop("changed", "valid_to"), [key, "valid_from"], ranges)
    before = beside(cut, [key], ["valid_from"], {"_before": F.col("change_hash")})
    marked = cut_lineage(before.withColumn("changed", ~F.col("change_hash").eqNullSafe(F.col("_before"))).drop("_before"))
    ending = beside(marked.where("changed"), [key], ["valid_from"], {"valid_to": F.col("valid_from")}, after=True)
    same = marked.where(~F.col("changed")).withColumn("valid_to", F.lit(None).cast(marked.schema["valid_from"].dataType))
    return ending.unionByName(same).drop(RANGE)


def current_rows(history: DataFrame, replaced: DataFrame, committed: DataFrame, key: str) -> DataFrame:
    """Rows of committed generations that no committed generation has replaced."""
    known = F.broadcast(committed.select("generation").distinct())  # one row a merge
    gone = replaced.join(known.withColumnRenamed("generation", "by"), "by", "left_semi").select(key, "generation")
    return history.join(known, "generation", "left_semi").join(gone, [key, "generation"], "left_anti")


def merge(history: DataFrame, arriving: DataFrame, key: str, ranges: int | None = None) -> tuple[DataFrame, DataFrame]:
    """The rows of all keys that ``arriving`` versions touch, and the ``(key, generation)`` rows they replace.

    ``history``: current rows with their generation.  Versions it holds already touch nothing.
    """
    known = history.select(key, "valid_from", "change_hash")
    new = cut_lineage(arriving.join(known, [key, "valid_from", "change_hash"], "left_anti"))
    touched = cut_lineage(new.select(key).distinct())
    touched = broadcast_if_small(touched, text_bytes(key))
    old = cut_lineage(history.join(touched, key, "left_semi"))
    columns = [c for c in old.columns if c not in ("generation", "changed", "valid_to")]
    together = _one_a_time(old.select(*columns).unionByName(new.select(*columns)), key)
    return intervals(together, key, ranges), old.select(key, "generation").distinct()


def as_of(history: DataFrame, time: Column) -> DataFrame:
    """The version of every key that holds at a time."""
    open_end = F.col("valid_to").isNull() | (F.col("valid_to") > time)
    return history.where(F.col("changed") & (F.col("valid_from") <= time) & open_end)
