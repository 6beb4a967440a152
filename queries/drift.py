"""Field inventories and drift between two versions of the orders feed."""

from pyspark.sql import functions as F

from attestra.operators import drift, inventory, registry
from queries import query


def feed(orders):
    """Old exports end in 1997.  The new ones rename a field, drop one, add a subtree, change a
    type, allow nulls and use a new label."""
    status = F.col("o_orderstatus")
    tier = F.when(F.col("o_totalprice") > 250000, "A").otherwise("B")
    new_tier = F.when(F.col("o_totalprice") > 450000, "C").otherwise(tier)
    customer = F.col("o_custkey").alias("key")
    old = F.to_json(
        F.struct(
            F.col("o_orderkey").alias("order_key"),
            F.struct(customer, tier.alias("tier")).alias("cust"),
            status.alias("order_status"),
            F.col("o_orderpriority").alias("priority"),
            F.concat(F.lit("clerk "), F.col("o_custkey")).alias("clerk"),
        )
    )
    keep = {"ignoreNullFields": "false"}
    lines = F.array(F.struct(F.lit(1).alias("qty")), F.struct(F.lit(2).alias("qty")))
    new = F.to_json(
        F.struct(
            F.col("o_orderkey").cast("string").alias("order_key"),
            F.struct(customer, new_tier.alias("tier")).alias("cust"),
            status.alias("status_code"),
            F.when(status != "P", F.col("o_orderpriority")).alias("priority"),
            lines.alias("lines"),
            F.array(F.col("o_orderpriority"), status).alias("tags"),
        ),
        keep,
    )
    is_old = F.year("o_orderdate") < 1998
    return orders.select(
        F.when(is_old, "2.1").otherwise("2.3").alias("api_version"), F.when(is_old, old).otherwise(new).alias("payload")
    )


def shapes(t):
    return inventory.inventory(feed(t.spread("orders")), ["api_version"])


FEED = """o AS (SELECT *, CASE WHEN o_totalprice > 250000 THEN 'A' ELSE 'B' END AS tier FROM orders),
v1 AS (SELECT * FROM o WHERE year(o_orderdate) < 1998),
v2 AS (SELECT *, CASE WHEN o_totalprice > 450000 THEN 'C' ELSE tier END AS tier2 FROM o WHERE year(o_orderdate) >= 1998)"""
VALUES = "list_aggregate(list_sort(list(DISTINCT {0})), 'string_agg', ',')"


def _field(version, path, types, factor="1", nulls="0", values=None):
    table = "v1" if version == "2.1" else "v2"
    shown = VALUES.format(values) if values else "NULL"
    return f"""SELECT '{version}' AS api_version, '{path}' AS path, '{types}' AS types,
  (count(*) * {factor})::BIGINT AS present_count, ({nulls})::BIGINT AS null_count, {shown} AS "values" FROM {table}"""


INVENTORY = "\nUNION ALL ".join(
    [
        _field("2.1", "order_key", "int"),
        _field("2.1", "cust", "object"),
        _field("2.1", "cust.key", "int"),
        _field("2.1", "cust.tier", "str", values="tier"),
        _field("2.1", "order_status", "str", values="o_orderstatus"),
        _field("2.1", "priority", "str", values="o_orderpriority"),
        _field("2.1", "clerk", "str"),
        _field("2.3", "order_key", "str"),
        _field("2.3", "cust", "object"),
        _field("2.3", "cust.key", "int"),
        _field("2.3", "cust.tier", "str", values="tier2"),
        _field("2.3", "status_code", "str", values="o_orderstatus"),
        _field("2.3", "priority", "str", nulls="count(*) FILTER (o_orderstatus = 'P')",
               values="CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority END").replace(
            "list(DISTINCT CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority END)",
            "list(DISTINCT o_orderpriority) FILTER (o_orderstatus <> 'P')"),
        _field("2.3", "lines", "array"),
        _field("2.3", "lines[].qty", "int", factor="2"),
        _field("2.3", "tags", "array"),
        _field("2.3", "tags[]", "str", factor="2").replace(
            'NULL AS "values"',
            "list_aggregate(list_sort(list_distinct(list_concat(list(DISTINCT o_orderpriority), list(DISTINCT o_orderstatus)))), 'string_agg', ',') AS \"values\"",
        ),
    ]
)


@query("field_inventory", f"WITH {FEED} {INVENTORY}")
def _(t):
    return shapes(t).select(
        "api_version", "path", F.array_join("types", ",").alias("types"), "present_count", "null_count",
        F.array_join("values", ",").alias("values"),
    )


V1 = "clerk:str|cust:object|cust.key:int|cust.tier:str|order_key:int|order_status:str|priority:str"
V2 = "cust:object|cust.key:int|cust.tier:str|lines:array|lines[].qty:int|order_key:str|priority:str|status_code:str|tags:array|tags[]:str"


@query(
    "schema_fingerprint",
    f"""WITH {FEED} SELECT DISTINCT '2.1' AS api_version, concat('sha256:', sha256('{V1}')) AS schema_fingerprint, 7::BIGINT AS paths FROM v1
UNION ALL SELECT DISTINCT '2.3', concat('sha256:', sha256('{V2}')), 10::BIGINT FROM v2""",
)
def _(t):
    return inventory.fingerprint(shapes(t), ["api_version"])


@query(
    "props_inventory",
    """SELECT event_type, 'k' AS path, 'int' AS types, count(*) AS present_count FROM events GROUP BY 1""",
)
def _(t):
    rows = t.spread("events").select("event_type", F.col("props").alias("payload"))
    return inventory.inventory(rows, ["event_type"]).select(
        "event_type", "path", F.array_join("types", ",").alias("types"), "present_count"
    )


def pair(t):
    both = shapes(t)
    fields = ("path", "types", "present_count", "null_count", "values")
    old = both.where("api_version = '2.1'").select(*fields)
    return old, both.where("api_version = '2.3'").select(*fields)


SCORE = """len(list_intersect((SELECT list(DISTINCT {a}) FROM v1), (SELECT list(DISTINCT {b}) FROM v2)))
 / len(list_distinct(list_concat((SELECT list(DISTINCT {a}) FROM v1), (SELECT list(DISTINCT {b}) FROM v2))))"""
STATUS_SCORE = SCORE.format(a="o_orderstatus", b="o_orderstatus")
TAG_SCORE = """len(list_intersect((SELECT list(DISTINCT o_orderstatus) FROM v1), (SELECT list_concat(list(DISTINCT o_orderstatus), list(DISTINCT o_orderpriority)) FROM v2)))
 / len(list_distinct(list_concat((SELECT list(DISTINCT o_orderstatus) FROM v1), (SELECT list_concat(list(DISTINCT o_orderstatus), list(DISTINCT o_orderpriority)) FROM v2))))"""


@query(
    "rename_candidates",
    f"""WITH {FEED} SELECT 'order_status' AS removed, 'status_code' AS added, round({STATUS_SCORE}, 4) AS score
UNION ALL SELECT 'order_status', 'tags[]', round({TAG_SCORE}, 4)""",
)
def _(t):
    return drift.rename_candidates(*pair(t)).select("removed", "added", F.round("score", 4).alias("score"))


EVENTS = f"""SELECT 'SUSPECTED_RENAME' AS kind, 'NEEDS_HUMAN_CONFIRMATION' AS severity, 'order_status -> status_code' AS path,
  '''order_status'' is gone and ''status_code'' is new; they share ' || CAST(floor(100 * {STATUS_SCORE}) AS BIGINT) || '% of their values. Probably one field under two names.' AS detail
UNION ALL SELECT 'FIELD_REMOVED', 'INFO', 'order_status', 'Not sent any more; its values seem to arrive as ''status_code''.'
UNION ALL SELECT 'FIELD_REMOVED', 'BREAKING', 'clerk', (SELECT count(*) FROM v1) || ' records carried it before and none does now. Whoever reads it gets nothing.'
UNION ALL SELECT 'FIELD_ADDED', 'ADDITIVE', 'lines', 'First seen now: type array, ' || (SELECT count(*) FROM v2) || ' records. 1 further path(s) below it. Kept as it came, not published.'
UNION ALL SELECT 'FIELD_ADDED', 'ADDITIVE', 'tags', 'First seen now: type array, ' || (SELECT count(*) FROM v2) || ' records. 1 further path(s) below it. Kept as it came, not published.'
UNION ALL SELECT 'TYPE_CHANGED', 'BREAKING', 'order_key', 'Was int, is str.'
UNION ALL SELECT 'NULLABILITY_CHANGED', 'WARN', 'priority', 'Always had a value; ' || (SELECT count(*) FROM v2 WHERE o_orderstatus = 'P') || ' of ' || (SELECT count(*) FROM v2) || ' are null now.'
UNION ALL SELECT 'ENUM_VALUE_ADDED', 'INFO', 'cust.tier', 'Values that did not occur before: C.'
UNION ALL SELECT 'API_VERSION_CHANGED', 'INFO', 'metadata.api_version', 'Declared version: 2.1, now 2.3.'"""


def events(t):
    both = shapes(t)
    prints = inventory.fingerprint(both, ["api_version"])
    counts = feed(t.spread("orders")).groupBy("api_version").agg(F.count(F.lit(1)).alias("record_count"))
    batches = prints.join(counts, "api_version").select(
        F.lit("orders").alias("source"),
        "api_version",
        F.col("schema_fingerprint").alias("fingerprint"),
        F.concat(F.lit("run "), "api_version").alias("run_id"),
        "record_count",
        F.when(F.col("api_version") == "2.1", "1998-01-01").otherwise("2001-12-31").alias("ingested_at"),
        F.when(F.col("api_version") == "2.1", 1).otherwise(2).cast("bigint").alias("seq"),
    )
    empty = t.spark.createDataFrame([], "source string, api_version string, fingerprint string, first_seen string, "
                                        "last_seen string, last_run_id string, record_count bigint, is_latest boolean")
    return batches, empty, both


@query("drift_events", f"WITH {FEED} {EVENTS}")
def _(t):
    batches, empty, both = events(t)
    fields = ("path", "types", "present_count", "null_count", "values")
    old = both.where("api_version = '2.1'").select(*fields)
    new = both.where("api_version = '2.3'").select(*fields)
    changed = registry.baseline(batches, empty).where("baseline_kind = 'diff'")
    found = drift.diff_inventories(old, new).unionByName(drift.version_change(changed))
    return found.select("kind", "severity", "path", "detail")


@query(
    "drift_summary",
    f"WITH {FEED}, e AS ({EVENTS}) SELECT severity, count(*) AS events FROM e WHERE kind <> 'API_VERSION_CHANGED' GROUP BY 1",
)
def _(t):
    return drift.drift_summary(drift.diff_inventories(*pair(t)))


@query(
    "drift_gate",
    f"""WITH {FEED}, e AS ({EVENTS}) SELECT count(*) AS events,
  bool_or(severity IN ('BREAKING', 'NEEDS_HUMAN_CONFIRMATION')) AS requires_human_action
FROM e WHERE kind <> 'API_VERSION_CHANGED'""",
)
def _(t):
    return drift.drift_gate(drift.diff_inventories(*pair(t)))


@query(
    "schema_registry",
    f"""WITH {FEED} SELECT 'orders' AS source, '2.1' AS api_version, concat('sha256:', sha256('{V1}')) AS fingerprint,
  '1998-01-01' AS first_seen, count(*) AS record_count, false AS is_latest FROM v1
UNION ALL SELECT 'orders', '2.3', concat('sha256:', sha256('{V2}')), '2001-12-31', count(*), true FROM v2""",
)
def _(t):
    batches, empty, _both = events(t)
    return registry.upsert(empty, batches).select(
        "source", "api_version", "fingerprint", "first_seen", "record_count", "is_latest"
    )


@query(
    "schema_baseline",
    f"""WITH {FEED} SELECT DISTINCT '2.1' AS api_version, NULL::VARCHAR AS previous_version, 'none' AS baseline_kind FROM v1
UNION ALL SELECT DISTINCT '2.3', '2.1', 'diff' FROM v2""",
)
def _(t):
    batches, empty, _both = events(t)
    return registry.baseline(batches, empty).select("api_version", "previous_version", "baseline_kind")


LEVELS_DEEP = 12
DEEP_PATHS = [".".join(f"k{d}" for d in range(n + 1)) for n in range(LEVELS_DEEP)]


@query(
    "deep_inventory",
    "\nUNION ALL ".join(
        f"SELECT '{p}' AS path, '{'object' if n < LEVELS_DEEP - 1 else 'int,str'}' AS types, count(*) AS present_count, "
        + ("CAST(NULL AS VARCHAR)" if n < LEVELS_DEEP - 1 else "string_agg(DISTINCT CASE WHEN o_orderkey % 2 = 1 THEN o_orderstatus END, ',' ORDER BY CASE WHEN o_orderkey % 2 = 1 THEN o_orderstatus END)")
        + ' AS "values" FROM orders'
        for n, p in enumerate(DEEP_PATHS)
    ),
)
def _(t):
    """Payloads that differ at the twelfth level only: a number in one half, a label in the other."""
    leaf = F.when(F.col("o_orderkey") % 2 == 1, F.concat(F.lit('"'), "o_orderstatus", F.lit('"'))).otherwise(
        F.col("o_custkey").cast("string")
    )
    opened = "".join(f'{{"k{d}":' for d in range(LEVELS_DEEP))
    payload = F.concat(F.lit(opened), leaf, F.lit("}" * LEVELS_DEEP))
    found = inventory.inventory(t.spread("orders").select(payload.alias("payload")))
    return found.select(
        "path", F.array_join("types", ",").alias("types"), "present_count", F.array_join("values", ",").alias("values")
    )
