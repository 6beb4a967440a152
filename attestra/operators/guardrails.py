"""Budget and failure-rate controls over an ordered run: who is processed, where it halts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from attestra import fixed_values as fixed
from attestra.operators.ordering import RANGE, accumulate, with_range


def running_spend(
    rows: DataFrame, order: Sequence[str], tokens: str = "tokens", cost: str = "cost_usd",
    group: Sequence[str] = (), ranges: int | None = None,
) -> DataFrame:
    """Tokens and cost spent *before* each row (``tokens_before``, ``cost_before``).

    Cost is summed as a decimal, so the totals do not depend on the order of addition.
    """
    return accumulate(
        rows,
        order,
        {"tokens_before": F.col(tokens).cast("bigint"), "cost_before": F.col(cost).cast("decimal(28,8)")},
        group,
        ranges=ranges,
    )


def budget_reason(max_tokens: int = fixed.MAX_TOTAL_TOKENS, max_cost: float = fixed.MAX_COST_USD) -> Column:
    """The budget check before a row: a ceiling already reached stops the run."""
    return F.when(
        (F.col("tokens_before") >= max_tokens) | (F.col("cost_before") >= F.lit(max_cost)), "budget_exceeded"
    )


def spend_fraction(max_tokens: int = fixed.MAX_TOTAL_TOKENS, max_cost: float = fixed.MAX_COST_USD) -> Column:
    """The larger share of the two ceilings; a ceiling of 0 counts as share 0."""
    parts = [F.lit(0.0)]
    if max_tokens:
        parts.append(F.col("tokens_before") / F.lit(max_tokens))
    if max_cost:
        parts.append((F.col("cost_before") / F.lit(max_cost)).cast("double"))
    return F.greatest(*parts, F.lit(0.0))


def budget_warning(
    spent: DataFrame, order: Sequence[str], max_tokens: int = fixed.MAX_TOTAL_TOKENS,
    max_cost: float = fixed.MAX_COST_USD, warn_at: float = fixed.WARN_AT_FRACTION, group: Sequence[str] = (),
) -> DataFrame:
    """The one row per run at which the warning is raised: first at or above the share, not halted."""
    at = spent.where(
        (spend_fraction(max_tokens, max_cost) >= warn_at) & budget_reason(max_tokens, max_cost).isNull()
    )
    first = F.min_by(F.struct(*order, "tokens_before", "cost_before"), F.struct(*order))
    return at.groupBy(*group).agg(first.alias("w")).where(F.col("w").isNotNull()).select(*group, "w.*")


def failure_state(
    rows: DataFrame, order: Sequence[str], failed: str = "failed", group: Sequence[str] = (),
    ranges: int | None = None,
) -> DataFrame:
    """Add ``processed_before``, ``failures_before`` and ``streak_before`` (consecutive failures).

    With F(i) the failures up to i, the streak after row i is F(i) minus F at the last success;
    F never falls, so that is the running maximum of F over successes.  Both are carried across
    ranges by one summary row per range.
    """
    cut = with_range(rows, [*group, *order], ranges)
    keys = [*group, RANGE]
    inside = Window.partitionBy(*keys).orderBy(*order)
    upto = inside.rowsBetween(Window.unboundedPreceding, 0)
    fail = F.when(F.col(failed), 1).otherwise(0).cast("bigint")
    local = (
        cut.withColumn("_f", F.sum(fail).over(upto))
        .withColumn("_n", F.row_number().over(inside).cast("bigint"))
        .withColumn("_s", F.max(F.when(~F.col(failed), F.col("_f"))).over(upto))
    )
    summary = local.groupBy(*keys).agg(
        F.max("_f").alias("_F"), F.max("_n").alias("_N"), F.max("_s").alias("_S")
    )
    by = [F.col(g) for g in group] or [F.lit(0)]
    earlier = Window.partitionBy(*by).orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    # Failures before a range are the sum of the earlier ranges; the last success before it is the
    # greatest (failures before its range + its own count) among them.
    offsets = (
        summary.withColumn("_F0", F.coalesce(F.sum("_F").over(earlier), F.lit(0)))
        .withColumn("_N0", F.coalesce(F.sum("_N").over(earlier), F.lit(0)))
        .withColumn("_S0", F.max(F.col("_F0") + F.col("_S")).over(earlier))
        .select(*keys, "_F0", "_N0", "_S0")
    )
    joined = local.join(offsets if group else F.broadcast(offsets), keys)
    failures_before = F.col("_F0") + F.col("_f") - fail
    last_success = F.coalesce(F.greatest(F.col("_S0"), F.col("_F0") + F.lag("_s").over(inside)), F.lit(0))
    return joined.select(
        *[F.col(c) for c in rows.columns],
        (F.col("_N0") + F.col("_n") - 1).alias("processed_before"),
        failures_before.alias("failures_before"),
        (failures_before - last_success).alias("streak_before"),
    )


def kill_reason(
    max_consecutive: int = fixed.MAX_CONSECUTIVE_FAILURES,
    max_rate: float = fixed.MAX_FAILURE_RATE,
    min_records: int = fixed.MIN_RECORDS_BEFORE_RATE_CHECK,
) -> Column:
    """The kill switch before a row: a failure streak first, then the failure rate."""
    rate = F.try_divide("failures_before", "processed_before")
    return F.when(F.col("streak_before") >= max_consecutive, "consecutive_failures").when(
        (F.col("processed_before") >= min_records) & (rate > max_rate), "error_rate"
    )


def first_halt(checked: DataFrame, order: Sequence[str], reason: Column, group: Sequence[str] = ()) -> DataFrame:
    """Per run the first row that must not start, and why (no row when nothing halts)."""
    hit = checked.withColumn("halt_reason", reason).where(F.col("halt_reason").isNotNull())
    first = F.min_by(F.struct(*[F.col(c).alias(f"halt_{c}") for c in order], "halt_reason"), F.struct(*order))
    return hit.groupBy(*group).agg(first.alias("h")).where(F.col("h").isNotNull()).select(*group, "h.*")


def guard_run(
    rows: DataFrame, order: Sequence[str], group: Sequence[str] = (), tokens: str = "tokens",
    cost: str = "cost_usd", failed: str = "failed", max_tokens: int = fixed.MAX_TOTAL_TOKENS,
    max_cost: float = fixed.MAX_COST_USD, max_consecutive: int = fixed.MAX_CONSECUTIVE_FAILURES,
    max_rate: float = fixed.MAX_FAILURE_RATE, min_records: int = fixed.MIN_RECORDS_BEFORE_RATE_CHECK,
    ranges: int | None = None,
) -> DataFrame:
    """Add ``halt_reason`` and ``admitted`` to every row: the kill switch looks first, then the budget.

    Rows from the first halted one on are not admitted; none is lost.  Both checks share one cut
    into ranges, so the rows are shuffled and sorted once.
    """
    cut = with_range(rows, [*group, *order], ranges)
    spent = running_spend(cut, order, tokens, cost, group)
    state = failure_state(spent, order, failed, group)
    reason = F.coalesce(
        kill_reason(max_consecutive, max_rate, min_records), budget_reason(max_tokens, max_cost)
    )
    halts = first_halt(state, order, reason, group)
    key = F.struct(*[F.col(c) for c in order])
    halt_key = F.struct(*[F.col(f"halt_{c}").alias(c) for c in order])
    if group:
        marked = state.join(halts, list(group), "left")
    else:
        # At most one row: the whole table has one first halt.
        marked = state.withColumn("_one", F.lit(1)).join(
            F.broadcast(halts.withColumn("_one", F.lit(1))), "_one", "left"
        ).drop("_one")
    admitted = F.col("halt_reason").isNull() | (key < halt_key)
    return (
        marked.withColumn("admitted", F.coalesce(admitted, F.lit(True)))
        .drop(*[f"halt_{c}" for c in order], RANGE)
        .withColumn("halt_reason", F.when(~F.col("admitted"), F.col("halt_reason")))
    )


def failure_rate(rows: DataFrame, failed: str = "failed", group: Sequence[str] = ()) -> DataFrame:
    return rows.groupBy(*group).agg(
        F.count(F.lit(1)).alias("processed"),
        F.count_if(F.col(failed)).alias("failures"),
        F.round(F.avg(F.when(F.col(failed), 1.0).otherwise(0.0)), 4).alias("failure_rate"),
    )


def guard_snapshot(
    guarded: DataFrame, tokens: str = "tokens", cost: str = "cost_usd", failed: str = "failed",
    max_tokens: int = fixed.MAX_TOTAL_TOKENS, max_cost: float = fixed.MAX_COST_USD, group: Sequence[str] = (),
) -> DataFrame:
    """Spent against ceiling, and the failure counts, over the rows that ran."""
    ran = F.col("admitted")
    share = lambda spent, ceiling: (
        F.round(spent / F.lit(ceiling), 4).cast("double") if ceiling else F.lit(0.0)
    )
    totals = guarded.groupBy(*group).agg(
        F.coalesce(F.sum(F.when(ran, F.col(tokens))), F.lit(0)).cast("bigint").alias("tokens_spent"),
        F.coalesce(F.sum(F.when(ran, F.col(cost).cast("decimal(28,8)"))), F.lit(0)).alias("_cost"),
        F.count_if(ran).alias("processed"),
        F.count_if(ran & F.col(failed)).alias("failures"),
        F.count_if(~ran).alias("not_processed"),
        F.max("halt_reason").alias("tripped_reason"),
    )
    return totals.select(
        *group,
        "tokens_spent",
        F.lit(max_tokens).cast("bigint").alias("tokens_budget"),
        share(F.col("tokens_spent"), max_tokens).alias("tokens_fraction"),
        F.round("_cost", 6).cast("double").alias("cost_usd_spent"),
        F.lit(float(max_cost)).alias("cost_usd_budget"),
        share(F.col("_cost").cast("double"), max_cost).alias("cost_fraction"),
        "processed",
        "failures",
        F.when(F.col("processed") > 0, F.round(F.col("failures") / F.col("processed"), 4))
        .otherwise(0.0)
        .alias("failure_rate"),
        "not_processed",
        "tripped_reason",
    )
