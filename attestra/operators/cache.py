"""Decision cache: look decisions up by content key, write new ones back, and cost totals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def lookup(
    requests: DataFrame, cache: DataFrame, key: str = "key", enabled: bool = True, spread_by: Sequence[str] = ()
) -> DataFrame:
    """Add ``value`` and ``cache_hit``.

    A key that many requests share is split by the skew join.  Requests without a key match nothing;
    ``spread_by`` (row keys) deals them out instead of gathering all nulls in one task.
    """
    if not enabled:
        return requests.withColumn("value", F.lit(None).cast("string")).withColumn("cache_hit", F.lit(False))
    asked = F.col(key)
    if spread_by:
        asked = F.coalesce(asked, F.concat(F.lit("no key "), F.xxhash64(*spread_by).cast("string")))
    found = requests.withColumn("_asked", asked).join(
        cache.select(F.col("key").alias("_asked"), "value"), "_asked", "left"
    )
    return found.drop("_asked").withColumn("cache_hit", F.col("value").isNotNull())


def billed(column: Column, hit: str = "cache_hit") -> Column:
    """A hit costs nothing."""
    return F.when(F.col(hit), F.lit(0)).otherwise(column)


def new_entries(decisions: DataFrame, cache: DataFrame, key: str = "key", value: str = "value") -> DataFrame:
    """One entry per key the cache does not hold yet (equal keys carry equal decisions)."""
    fresh = decisions.where(F.col(value).isNotNull()).groupBy(key).agg(F.min(value).alias("value"))
    return fresh.withColumnRenamed(key, "key").join(cache.select("key"), "key", "left_anti").select("key", "value")


def hit_rate(looked_up: DataFrame, group: Sequence[str] = ()) -> DataFrame:
    return looked_up.groupBy(*group).agg(
        F.count_if("cache_hit").alias("hits"),
        F.count_if(~F.col("cache_hit")).alias("misses"),
        F.round(F.coalesce(F.avg(F.when(F.col("cache_hit"), 1.0).otherwise(0.0)), F.lit(0.0)), 4).alias("hit_rate"),
    )


def usage_totals(
    calls: DataFrame, group: Sequence[str] = (), input_tokens: str = "input_tokens",
    output_tokens: str = "output_tokens", cost: str = "cost_usd", error: Column | None = None,
) -> DataFrame:
    """Calls, errors, tokens and cost.  Decimal cost: the sum is the same in any order."""
    error = F.lit(False) if error is None else error
    return calls.groupBy(*group).agg(
        F.count_if(~error).alias("calls"),
        F.count_if(error).alias("errors"),
        F.coalesce(F.sum(F.when(~error, F.col(input_tokens))), F.lit(0)).cast("bigint").alias("input_tokens"),
        F.coalesce(F.sum(F.when(~error, F.col(output_tokens))), F.lit(0)).cast("bigint").alias("output_tokens"),
        F.coalesce(F.sum(F.when(~error, F.col(input_tokens) + F.col(output_tokens))), F.lit(0))
        .cast("bigint")
        .alias("total_tokens"),
        F.round(F.coalesce(F.sum(F.when(~error, F.col(cost).cast("decimal(28,8)"))), F.lit(0)), 6)
        .cast("double")
        .alias("cost_usd"),
    )
