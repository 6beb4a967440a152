"""Token estimates, prices, cache keys and usage read from model responses."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from attestra import fixed_values as fixed
from attestra.functions.binding import bind


def token_estimate(text: Column) -> Column:
    return F.greatest(F.lit(1), F.floor(F.length(text) / fixed.CHARS_PER_TOKEN)).cast("bigint")


def price(
    input_tokens: Column,
    output_tokens: Column,
    input_per_1m: float = fixed.INPUT_USD_PER_1M,
    output_per_1m: float = fixed.OUTPUT_USD_PER_1M,
) -> Column:
    """Cost in USD, eight decimal places, as a decimal so that sums do not depend on order."""
    dollars = (
        input_tokens / F.lit(1_000_000) * F.lit(input_per_1m)
        + output_tokens / F.lit(1_000_000) * F.lit(output_per_1m)
    )
    return F.round(dollars, 8).cast("decimal(28,8)")


def usage(input_tokens: Column, output_tokens: Column, **prices: float) -> Column:
    return F.struct(
        input_tokens.cast("bigint").alias("input_tokens"),
        output_tokens.cast("bigint").alias("output_tokens"),
        (input_tokens + output_tokens).cast("bigint").alias("total_tokens"),
        price(input_tokens, output_tokens, **prices).cast("double").alias("cost_usd"),
    )


def no_usage() -> Column:
    return usage(F.lit(0), F.lit(0))


def cache_key(prompt: Column, model_name: Column, prompt_version: Column) -> Column:
    """Content-addressed: a new prompt version or model never meets an old decision."""
    return F.substring(F.sha2(F.concat_ws("|", model_name, prompt_version, prompt), 256), 1, 32)


def response_usage(response: Column) -> Column:
    """Usage struct from a response in JSON text: current location first, then the older one."""

    def read(node: Column) -> Column:
        def number(path: str) -> Column:
            return F.coalesce(F.try_variant_get(node, path, "bigint"), F.lit(0))

        current = F.size(F.try_variant_get(node, "$.usage_metadata", "map<string,variant>")) > 0
        old_in = number("$.llm_output.token_usage.prompt_tokens")
        old_out = number("$.llm_output.token_usage.completion_tokens")
        return F.when(
            F.coalesce(current, F.lit(False)),
            F.struct(
                number("$.usage_metadata.input_tokens").alias("input_tokens"),
                number("$.usage_metadata.output_tokens").alias("output_tokens"),
                number("$.usage_metadata.total_tokens").alias("total_tokens"),
            ),
        ).otherwise(
            F.struct(
                old_in.alias("input_tokens"),
                old_out.alias("output_tokens"),
                (old_in + old_out).alias("total_tokens"),
            )
        )

    return bind(F.try_parse_json(response), read)
