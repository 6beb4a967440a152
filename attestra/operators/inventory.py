"""What fields a batch of JSON records carries: paths, types, nulls, small value sets."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attestra import fixed_values as fixed
from attestra.functions.json_values import type_name
from attestra.session import broadcast_if_small, cut_lineage, text_bytes

LEVELS = 4  # levels that one scan opens
TYPES = ("array", "bool", "float", "int", "object", "str")


# One depth level of the walk, from table ``{before}`` to table ``{after}``.  Rows without a node pass
# through; a child's value is never null (JSON null is a variant).  A listed container stands for
# itself and is opened in a second copy.
LEVEL = """
{after}_children AS (
  SELECT {keys}
    CASE WHEN value IS NULL THEN path WHEN key IS NULL THEN concat(path, '[]')
         WHEN path IS NULL THEN key ELSE concat(path, '.', key) END AS path,
    CASE WHEN value IS NULL THEN kind ELSE schema_of_variant(value) END AS kind, text, key, value
  FROM {before}, LATERAL variant_explode_outer(node)
  WHERE node IS NULL OR value IS NOT NULL),
{after}_typed AS (
  SELECT {keys} path, kind,
    CASE WHEN value IS NULL THEN text WHEN kind = 'STRING' THEN CAST(value AS STRING) END AS text,
    CASE WHEN value IS NOT NULL AND (kind LIKE 'OBJECT%' OR kind LIKE 'ARRAY%') THEN value END AS node,
    value IS NOT NULL AND key IS NOT NULL AND (kind LIKE 'OBJECT%' OR kind LIKE 'ARRAY%') AS both
  FROM {after}_children),
{after} AS (
  SELECT {keys} path, kind, text, CASE WHEN NOT own THEN node END AS node
  FROM {after}_typed LATERAL VIEW explode(CASE WHEN both THEN array(true, false) ELSE array(false) END) AS own)"""


def _walk(level: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``LEVELS`` levels below the containers of ``level`` (``keys..., path, node``), in one scan.

    Rows ``(keys..., path, kind, text, node)``: a field occurrence, or (``node`` is not null) a container
    that is still to be opened.  Every level is a generator over the same row stream, inside one
    code-generated stage.  Array items share ``path[]``; container items are opened, not listed.
    """
    own = "".join(f"`{k}`, " for k in keys)
    levels = ",".join(LEVEL.format(before=f"level_{i}", after=f"level_{i + 1}", keys=own) for i in range(LEVELS))
    # A payload that is no container leaves one row without a path.
    return level.sparkSession.sql(
        f"""WITH level_0 AS (
  SELECT {own} path, CAST(NULL AS STRING) AS kind, CAST(NULL AS STRING) AS text, node FROM {{level}}),{levels}
SELECT {own} path, kind, text, node FROM level_{LEVELS} WHERE path IS NOT NULL""",
        level=level,
    )


def inventory(records: DataFrame, keys: Sequence[str] = (), payload: str = "payload") -> DataFrame:
    """Per path: types, present and null counts, and the values of low-cardinality strings.

    Fields of every depth are found: containers below the first levels are written and opened in a
    further round, until none is left; records without such containers cost no round.  The first pass of
    a round also marks, for each path, the slots (of 64) that its short strings hash to.  A path has at
    least as many distinct values as slots, so one with more slots than the limit is out for certain, and
    the second pass collects values only for the paths that are left: identifiers never reach a shuffle.
    Types travel as a bit mask.
    """
    kind = type_name(F.col("kind"))
    short = F.when(F.length("text") <= fixed.VALUE_TRACKING_MAX_LENGTH, F.col("text"))
    bit = F.lit(0)
    for i, name in enumerate(TYPES):
        bit = F.when(F.col("_kind") == name, F.lit(1 << i)).otherwise(bit)
    slot = F.expr("IF(_short IS NULL, NULL, shiftleft(1L, CAST(pmod(xxhash64(_short), 64) AS INT)))")
    on = [*keys, "path"]

    level = records.select(
        *keys, F.lit(None).cast("string").alias("path"), F.try_parse_json(F.col(payload)).alias("node")
    )
    rounds, fields = [], []
    while True:
        walked = _walk(level, keys)
        listed = F.col("node").isNull()
        found = cut_lineage(
            walked.select(*on, kind.alias("_kind"), short.alias("_short"), listed.alias("_listed"))
            .groupBy(*on)
            .agg(
                F.bit_or(F.when(F.col("_listed"), bit)).alias("_mask"),
                F.count_if("_listed").alias("present_count"),
                F.count_if(F.col("_listed") & (F.col("_kind") == "null")).alias("null_count"),
                F.bit_or(F.when(F.col("_listed"), slot)).alias("_slots"),
                F.max(~F.col("_listed")).alias("_closed"),
            )
        )
        rounds.append(found.where("present_count > 0"))
        fields.append(walked.where(listed).select(*on, short.alias("value")))
        if found.where("_closed").isEmpty():
            break
        level = cut_lineage(walked.where(~listed).select(*on, "node"))
    stats = rounds[0]
    if len(rounds) > 1:
        stats = reduce(DataFrame.unionByName, rounds).groupBy(*on).agg(
            F.bit_or("_mask").alias("_mask"),
            F.sum("present_count").alias("present_count"),
            F.sum("null_count").alias("null_count"),
            F.bit_or("_slots").alias("_slots"),
        )
        stats = cut_lineage(stats)
    few = F.bit_count("_slots").between(1, fixed.ENUM_CARDINALITY_LIMIT)
    candidates = stats.where(few).select(*on)
    distinct_values = (
        reduce(DataFrame.unionByName, fields)
        .where(F.col("value").isNotNull())
        .join(broadcast_if_small(candidates, text_bytes(*on)), on, "left_semi")
        .distinct()
    )
    # At most a few dozen distinct values are left per path.
    values = (
        distinct_values.groupBy(*on)
        .agg(F.array_sort(F.collect_list("value")).alias("values"))
        .where(F.size("values") <= fixed.ENUM_CARDINALITY_LIMIT)
    )
    types = F.array_compact(
        F.array(*[F.when(F.col("_mask").bitwiseAND(1 << i) != 0, F.lit(n)) for i, n in enumerate(TYPES)])
    )
    found = stats.join(values, on, "left").select(
        *keys, "path", types.alias("types"), "present_count", "null_count", "values"
    )
    # Schema-sized from here on; whoever reads it twice does not scan the records again.
    return cut_lineage(found)


def fingerprint(inventories: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Stable hash of a batch's shape: sorted ``path:types`` entries joined by ``|``."""
    entries = F.array_sort(
        F.collect_list(
            F.struct("path", F.concat_ws(":", "path", F.concat_ws(",", "types")).alias("entry"))
        )
    )
    text = F.array_join(F.transform(entries, lambda e: e["entry"]), "|")
    return inventories.groupBy(*keys).agg(
        F.concat(F.lit("sha256:"), F.sha2(text, 256)).alias("schema_fingerprint"),
        F.count(F.lit(1)).alias("paths"),
    )


def is_categorical(values: Column, present_count: Column) -> Column:
    """Labels, not data: every distinct value repeats often enough on average."""
    return F.coalesce(
        (F.size(values) > 0) & (F.size(values) * fixed.ENUM_MIN_REPETITION <= present_count), F.lit(False)
    )
