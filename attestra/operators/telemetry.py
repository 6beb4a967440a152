"""Metric snapshots and log/span correlation over telemetry tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attestra.operators.ordering import nth_in_group


def p95_rank(n: Column) -> Column:
    """1-based nearest rank: ``min(n - 1, floor(0.95 n)) + 1``."""
    return F.least(n - 1, F.floor(n * F.lit(0.95))) + 1


def counters(observations: DataFrame, name: str = "name", value: str = "value") -> DataFrame:
    return observations.groupBy(name).agg(F.sum(value).alias("total"))


def histograms(
    observations: DataFrame, name: str = "name", value: str = "value", tie: Sequence[str] = (), ranges: int | None = None
) -> DataFrame:
    """Per metric: count, sum, min, max, average and the exact 95th percentile.

    The percentile is found by counting ranges and sorting only the one that holds the rank.
    ``tie`` makes the order total, so that a value repeated many times can be split.
    """
    basic = observations.groupBy(name).agg(
        F.count(value).alias("count"),
        F.round(F.sum(value), 3).alias("sum"),
        F.round(F.min(value), 3).alias("min"),
        F.round(F.max(value), 3).alias("max"),
        F.round(F.avg(value), 3).alias("avg"),
    )
    seen = observations.where(F.col(value).isNotNull()).select(name, value, *tie)
    ranked = nth_in_group(seen, [name], [value, *tie], p95_rank(F.col("_n")), ranges)
    return basic.join(ranked.select(name, F.round(value, 3).alias("p95")), name)


def logs_with_spans(logs: DataFrame, spans: DataFrame) -> DataFrame:
    """Log lines with the span they were written in (lines outside any span are kept)."""
    side = spans.select("trace_id", "span_id", F.col("name").alias("span_name"), F.col("status").alias("span_status"))
    return logs.join(side, ["trace_id", "span_id"], "left")


def uncorrelated(logs: DataFrame, spans: DataFrame) -> DataFrame:
    """Log lines that name a span nobody recorded."""
    return logs.where(F.col("span_id").isNotNull()).join(
        spans.select("trace_id", "span_id"), ["trace_id", "span_id"], "left_anti"
    )
