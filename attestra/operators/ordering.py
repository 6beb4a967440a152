"""Running totals and numbering over a whole table without a one-task window.

A window with no partition key sends every row to one task.  Here rows are first partitioned by
order ranges and written with the number of their range; each range keeps a small summary, the
summaries are accumulated (one row per range), and the window runs inside the ranges.  Every
branch and every retried task reads the written ranges, so all see the same cut.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from attestra.session import cut_lineage

RANGE = "_range"


def with_range(
    df: DataFrame, order: Sequence[str], ranges: int | None = None, name: str = RANGE
) -> DataFrame:
    """The rows partitioned by ranges of ``order``, with the number of their range.

    A table that carries range numbers already keeps them.
    """
    if name in df.columns:
        return df
    dealt = df.repartitionByRange(ranges, *order) if ranges else df.repartitionByRange(*order)
    return cut_lineage(dealt.withColumn(name, F.spark_partition_id()))


def _by(group: Sequence[str]) -> list[Column]:
    return [F.col(g) for g in group] or [F.lit(0)]


def accumulate(
    df: DataFrame,
    order: Sequence[str],
    sums: Mapping[str, Column],
    group: Sequence[str] = (),
    inclusive: bool = False,
    ranges: int | None = None,
) -> DataFrame:
    """Add running sums in ``order`` (within each ``group``), before or including the row.

    ``order`` must be total within the group.  A group that holds most of the table is spread
    over many ranges like any other rows.
    """
    cut = with_range(df, [*group, *order], ranges)
    keys = [*group, RANGE]
    summary = cut.groupBy(*keys).agg(*[F.sum(c).alias(f"_sum_{n}") for n, c in sums.items()])
    earlier = Window.partitionBy(*_by(group)).orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    offsets = summary.select(
        *keys,
        *[F.coalesce(F.sum(f"_sum_{n}").over(earlier), F.lit(0)).alias(f"_before_{n}") for n in sums],
    )
    inside = (
        Window.partitionBy(*keys)
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    )
    joined = cut.join(offsets, keys, "left") if group else cut.join(F.broadcast(offsets), keys, "left")
    return joined.select(
        *[joined[c] for c in df.columns],
        *[
            (F.col(f"_before_{n}") + F.coalesce(F.sum(c).over(inside), F.lit(0))).alias(n)
            for n, c in sums.items()
        ],
    )


def number_rows(
    df: DataFrame, order: Sequence[str], name: str = "seq", group: Sequence[str] = (), ranges: int | None = None
) -> DataFrame:
    """A gap-free sequence starting at 1 over the whole table (or within each group)."""
    out = accumulate(df, order, {name: F.lit(1).cast("bigint")}, group, inclusive=True, ranges=ranges)
    return out.withColumn(name, F.col(name).cast("bigint"))


def nth_in_group(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str],
    rank_of: Column,
    ranges: int | None = None,
) -> DataFrame:
    """The one row of each group that stands at a given rank (1-based).

    ``rank_of`` is an expression over ``_n``, the group's row count.  Only the range that holds
    the rank is sorted, so a huge group costs one range, not one task for all of it.
    """
    cut = with_range(df, [*group, *order], ranges)
    sizes = cut.groupBy(*group, RANGE).agg(F.count(F.lit(1)).alias("_size"))
    everything = Window.partitionBy(*_by(group))
    upto = everything.orderBy(RANGE).rowsBetween(Window.unboundedPreceding, 0)
    target = (
        sizes.withColumn("_n", F.sum("_size").over(everything))
        .withColumn("_upto", F.sum("_size").over(upto))
        .withColumn("_rank", rank_of.cast("bigint"))
        .where((F.col("_rank") <= F.col("_upto")) & (F.col("_rank") > F.col("_upto") - F.col("_size")))
        .select(*group, RANGE, (F.col("_rank") - F.col("_upto") + F.col("_size")).alias("_local"))
    )
    inside = Window.partitionBy(*group, RANGE).orderBy(*order)
    return (
        cut.join(target, [*group, RANGE])
        .withColumn("_row", F.row_number().over(inside))
        .where(F.col("_row") == F.col("_local"))
        .select(*df.columns)
    )


def beside(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str],
    values: Mapping[str, Column],
    after: bool = False,
    ranges: int | None = None,
) -> DataFrame:
    """Add ``values`` of the row before (or ``after``) each row in ``order`` within its group; null at the ends.

    ``order`` must be total within the group.  Rows are cut into ranges of (group, order); what a range
    cannot see is the nearest row of the range next door, one row per range, which is carried over.  A group of any
    size is spread over many tasks.  Columns that ``values`` name and the table has are replaced.
    """
    cut = with_range(df, [*group, *order], ranges)
    value = F.struct(*[c.alias(n) for n, c in values.items()])
    inside = Window.partitionBy(*group, RANGE).orderBy(*order)
    near = (F.lead if after else F.lag)(value).over(inside)
    place = F.struct(*[F.col(c) for c in (*group, *order)])
    own = F.struct(F.struct(*[F.col(c) for c in group], F.lit(0).alias("_0")).alias("group"), value.alias("value"))
    edges = cut.groupBy(RANGE).agg((F.min_by if after else F.max_by)(own, place).alias("_own"))
    # One row per range.
    along = Window.partitionBy(F.lit(0)).orderBy(RANGE)
    edges = edges.select(RANGE, (F.lead if after else F.lag)("_own").over(along).alias("_edge"))
    same = F.col("_edge").isNotNull()
    for c in group:
        same = same & F.col(c).eqNullSafe(F.col(f"_edge.group.`{c}`"))
    joined = cut.join(F.broadcast(edges), RANGE, "left")
    joined = joined.withColumn("_near", F.coalesce(near, F.when(same, F.col("_edge.value"))))
    return joined.select(*[c for c in df.columns if c not in values], *[F.col(f"_near.`{n}`").alias(n) for n in values])
