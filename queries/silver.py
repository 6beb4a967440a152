"""Bronze to Silver on the orders table: three source versions name the status differently."""

from pyspark.sql import functions as F

from attestra.functions import json_values
from attestra.operators import history, landing, silver
from attestra.session import cut_lineage
from queries import query

CONTRACT = silver.Contract(
    stable=("order_key", "customer_key", "order_date"),
    unified="status",
    conditional={"priority": "string"},
    order=("order_key", "customer_key", "order_date", "status", "priority"),
)
ALIASES = {"order_status": "status", "status_code": "status"}


def versioned(orders):
    """Before 1998: ``order_status``; from 1998: ``status_code`` and ``channel``; from 2000 the
    unified name itself, null for half-finished orders, next to an old alias."""
    key = F.col("o_orderkey").cast("string").alias("order_key")
    customer = F.col("o_custkey").cast("string").alias("customer_key")
    date = F.date_format("o_orderdate", "yyyy-MM-dd").alias("order_date")
    status = F.col("o_orderstatus")
    keep = {"ignoreNullFields": "false"}
    old = F.to_json(F.struct(key, customer, date, status.alias("order_status")), keep)
    middle = F.to_json(
        F.struct(status.alias("status_code"), key, customer, date, F.col("o_orderpriority").alias("priority"),
                 F.lit("web").alias("channel")),
        keep,
    )
    new = F.to_json(
        F.struct(key, F.when(status != "P", status).alias("status"), customer, date, status.alias("status_code")), keep
    )
    year = F.year("o_orderdate")
    version = F.when(year < 1998, "1").when(year < 2000, "2").otherwise("3")
    payload = F.when(year < 1998, old).when(year < 2000, middle).otherwise(new)
    return orders.select(
        version.alias("version"), F.col("o_orderkey").alias("record_index"), payload.alias("payload"), "o_orderstatus"
    )


ORDERS = """o AS (SELECT o_orderkey::VARCHAR AS order_key, o_custkey::VARCHAR AS customer_key,
  strftime(o_orderdate, '%Y-%m-%d') AS order_date, o_orderstatus,
  CASE WHEN year(o_orderdate) < 1998 THEN '1' WHEN year(o_orderdate) < 2000 THEN '2' ELSE '3' END AS version,
  o_orderpriority FROM orders),
s AS (SELECT order_key, customer_key, order_date, version, o_orderstatus,
  CASE WHEN version = '3' AND o_orderstatus = 'P' THEN NULL ELSE o_orderstatus END AS status,
  CASE WHEN version = '2' THEN o_orderpriority END AS priority,
  CASE version WHEN '1' THEN '' WHEN '2' THEN 'channel' ELSE 'status' END AS unmapped FROM o)"""


@query("silver_orders", f"WITH {ORDERS} SELECT order_key, customer_key, order_date, version, status, priority, unmapped FROM s")
def _(t):
    rows = silver.normalise(versioned(t.spread("orders")), ALIASES, CONTRACT)
    return rows.select(
        "order_key", "customer_key", "order_date", "version", "status", "priority",
        F.array_join("_unmapped_fields", ",").alias("unmapped"),
    )


@query(
    "silver_null_counts",
    f"""WITH {ORDERS} SELECT unnest(['order_key','customer_key','order_date','status','priority']) AS field,
  unnest([count(*) - count(order_key), count(*) - count(customer_key), count(*) - count(order_date),
          count(*) - count(status), count(*) - count(priority)]) AS null_count FROM s""",
)
def _(t):
    return silver.null_counts(silver.normalise(versioned(t.spread("orders")), ALIASES, CONTRACT), CONTRACT.order)


@query(
    "silver_unconfirmed_alias",
    f"""WITH {ORDERS} SELECT version, count(*) AS records,
  count(CASE WHEN version = '1' THEN order_key WHEN version = '3' AND o_orderstatus <> 'P' THEN order_key END) AS with_status,
  CASE version WHEN '1' THEN '' WHEN '2' THEN 'channel,status_code' ELSE 'status,status_code' END AS unmapped
FROM s GROUP BY version""",
)
def _(t):
    # Only the old name is confirmed: the new one stays null and is listed as unmapped.
    rows = silver.normalise(versioned(t.spread("orders")), {"order_status": "status"}, CONTRACT)
    return rows.groupBy("version", F.array_join("_unmapped_fields", ",").alias("unmapped")).agg(
        F.count(F.lit(1)).alias("records"), F.count("status").alias("with_status")
    )


@query(
    "silver_key_collisions",
    "SELECT o_custkey::VARCHAR AS customer_key, count(*) AS records FROM orders GROUP BY 1 HAVING count(*) > 1",
)
def _(t):
    rows = silver.normalise(versioned(t.spread("orders")), ALIASES, CONTRACT)
    return silver.key_collisions(rows, "customer_key")


@query(
    "silver_issues",
    f"""WITH {ORDERS} SELECT 'unmapped_fields' AS issue, count(*) AS records FROM s WHERE unmapped <> ''
UNION ALL SELECT 'missing_status', count(*) FROM s WHERE status IS NULL""",
)
def _(t):
    rows = silver.normalise(versioned(t.spread("orders")), ALIASES, CONTRACT)
    return silver.issues(rows, "order_key", "status").groupBy("issue").agg(F.count(F.lit(1)).alias("records"))


def replayed(orders):
    """The half-finished orders arrive twice."""
    first = versioned(orders).withColumn("record_hash", json_values.record_hash(F.col("payload")))
    again = first.where(F.col("o_orderstatus") == "P")
    return first.withColumn("replay", F.lit(0)).unionByName(again.withColumn("replay", F.lit(1)))


@query(
    "normalisation_report",
    f"""WITH {ORDERS}, c AS (SELECT count(*) AS n FROM (SELECT customer_key FROM s GROUP BY 1 HAVING count(*) > 1))
SELECT count(*) + count(*) FILTER (o_orderstatus = 'P') AS bronze_records_read, count(*) AS silver_records,
  count(*) FILTER (unmapped <> '') AS records_with_unmapped_fields, count(*) FILTER (status IS NULL) AS records_without_status,
  (SELECT n FROM c) AS key_collisions, count(*) FILTER (o_orderstatus = 'P') AS duplicates_dropped FROM s""",
)
def _(t):
    bronze = replayed(t.spread("orders"))
    unique = landing.keep_first(bronze, "record_hash", ("version", "replay", "record_index"))
    return silver.normalisation_report(
        bronze, silver.normalise(unique, ALIASES, CONTRACT), "customer_key", "status"
    )


@query(
    "lineage_orphans",
    """SELECT o_orderkey AS record_index FROM orders WHERE o_orderstatus = 'P'""",
)
def _(t):
    # Bronze without the half-finished orders: exactly those lose their lineage.
    hashed = versioned(t.spread("orders")).withColumn("record_hash", json_values.record_hash(F.col("payload")))
    bronze = hashed.where(F.col("o_orderstatus") != "P")
    return silver.lineage_orphans(hashed, bronze).select("record_index")


@query(
    "contract_violations",
    """SELECT c_custkey, '$.c_acctbal' AS path, 'minimum' AS rule FROM customer WHERE c_acctbal < 0
UNION ALL SELECT c_custkey, '$.c_mktsegment', 'enum' FROM customer WHERE c_mktsegment = 'MACHINERY'
UNION ALL SELECT c_custkey, '$.c_name', 'pattern' FROM customer WHERE NOT regexp_matches(c_name, '^Customer#0000[0-9]*[02468]$')
UNION ALL SELECT c_custkey, '$.c_phone', 'required' FROM customer""",
)
def _(t):
    from attestra.operators.contract import contract_violations

    schema = {
        "type": "object",
        "additionalProperties": False,
        "required": ["c_custkey", "c_name", "c_phone"],
        "properties": {
            "c_custkey": {"type": "integer"},
            "c_name": {"type": "string", "pattern": "^Customer#0000[0-9]*[02468]$"},
            "c_nationkey": {"type": "integer", "minimum": 0},
            "c_acctbal": {"type": "number", "minimum": 0},
            "c_mktsegment": {"type": "string", "enum": ["BUILDING", "AUTOMOBILE", "FURNITURE", "HOUSEHOLD"]},
        },
    }
    rows = t.spread("customer").select("c_custkey", F.to_json(F.struct("*")).alias("payload"))
    return contract_violations(rows, schema, "c_custkey")


# An order is a version of its customer's account, valid from its date.  Finished orders arrive first; open ones
# come later and are dated between them.
ACCOUNT = """v AS (
  SELECT o_custkey, o_orderdate, o_orderpriority FROM orders
  QUALIFY row_number() OVER (PARTITION BY o_custkey, o_orderdate ORDER BY o_orderkey DESC) = 1
), c AS (
  SELECT *, lag(o_orderpriority) OVER (PARTITION BY o_custkey ORDER BY o_orderdate) IS DISTINCT FROM o_orderpriority AS changed FROM v
), h AS (
  SELECT o_custkey, o_orderpriority, o_orderdate AS valid_from,
    lead(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate) AS valid_to
  FROM c WHERE changed
)"""


def account_history(t):
    orders = t.orders.select("o_custkey", "o_orderdate", "o_orderpriority", "o_orderkey", "o_orderstatus")
    arriving = [
        history.versions(part, "o_custkey", F.col("o_orderdate"), ["o_orderpriority"], F.col("o_orderkey"))
        for part in (orders.where("o_orderstatus = 'F'"), orders.where("o_orderstatus <> 'F'"))
    ]
    first = history.intervals(arriving[0], "o_custkey").withColumn("generation", F.lit(0))
    first = cut_lineage(first)
    merged, replaced = history.merge(first, arriving[1], "o_custkey")
    kept = first.join(replaced, ["o_custkey", "generation"], "left_anti").drop("generation")
    return kept.unionByName(merged)


@query("silver_history", f"""WITH {ACCOUNT} SELECT o_custkey, o_orderpriority, strftime(valid_from, '%Y-%m-%d') AS valid_from,
  strftime(valid_to, '%Y-%m-%d') AS valid_to FROM h""")
def _(t):
    held = account_history(t).where("changed")
    days = [F.date_format(c, "yyyy-MM-dd").alias(c) for c in ("valid_from", "valid_to")]
    return held.select("o_custkey", "o_orderpriority", *days)


@query(
    "silver_as_of",
    f"""WITH {ACCOUNT} SELECT o_orderpriority, count(*) AS accounts FROM h
WHERE valid_from <= TIMESTAMP '1998-07-01' AND (valid_to IS NULL OR valid_to > TIMESTAMP '1998-07-01') GROUP BY 1""",
)
def _(t):
    held = history.as_of(account_history(t), F.lit("1998-07-01").cast("timestamp"))
    return held.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("accounts"))
