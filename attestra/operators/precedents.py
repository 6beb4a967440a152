"""Accepted language from the corpus itself: clean records of the same category."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from attestra import fixed_values as fixed
from attestra.functions.binding import evaluated_once


def clean_index(rows: DataFrame, category: str = "review_category", key: str = "clause_id") -> DataFrame:
    """Records with no finding, in long form (a category may hold most of the corpus)."""
    return rows.where(F.size("findings") == 0).select(
        F.coalesce(F.col(category), F.lit("other")).alias("category"), F.col(key).alias("precedent_id")
    )


def clean_counts(index: DataFrame) -> DataFrame:
    return index.groupBy("category").agg(F.count(F.lit(1)).alias("clean_records"))


def first_clean(index: DataFrame, order: Sequence[str] = ("precedent_id",), limit: int = fixed.PRECEDENT_LIMIT) -> DataFrame:
    """Per category an ordered array of its first ``limit + 1`` clean records.

    One more than the limit, because a record never cites itself.  The rank filter prunes
    inside every input task, so at most limit + 1 rows per category and task are shuffled.
    """
    ranked = F.row_number().over(Window.partitionBy("category").orderBy(*order))
    top = index.withColumn("_n", ranked).where(F.col("_n") <= limit + 1)
    return top.groupBy("category").agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("_n", "precedent_id"))), lambda p: p["precedent_id"]
        ).alias("_first")
    )


def with_precedents(
    rows: DataFrame,
    first: DataFrame,
    category: str = "review_category",
    key: str = "clause_id",
    limit: int = fixed.PRECEDENT_LIMIT,
    broadcast: bool = True,
) -> DataFrame:
    """Write up to ``limit`` precedents into every finding that has none.

    ``first`` has one row per category.  Review categories are a fixed list of seven, which
    bounds the broadcast; pass ``broadcast=False`` for an open category set.
    """
    side = first.withColumnRenamed("category", "_category")
    joined = rows.join(
        F.broadcast(side) if broadcast else side,
        F.coalesce(F.col(category), F.lit("other")) == F.col("_category"),
        "left",
    )
    others = F.slice(
        F.filter(F.coalesce("_first", F.array().cast("array<string>")), lambda p: p != F.col(key)), 1, limit
    )
    filled = F.transform(
        "findings",
        lambda f: f.withField(
            "precedent_clause_ids",
            F.when(F.size(f["precedent_clause_ids"]) > 0, f["precedent_clause_ids"]).otherwise(others),
        ),
    )
    return evaluated_once(joined.withColumn("findings", filled).drop("_first", "_category"))
