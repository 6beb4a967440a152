"""Which orders of a customer replace earlier ones of the same section."""

from pyspark.sql import functions as F

from attestra import schemas
from attestra.functions.text import is_amendment, section_key
from attestra.operators import supersession
from queries import query

SECTION = """concat('Section ', CAST(month(o_orderdate) AS STRING), '.', CAST(o_custkey % 3 AS STRING),
  CASE WHEN o_orderpriority = '1-URGENT' THEN ' (Amended)' WHEN o_orderpriority = '2-HIGH' THEN ' ( amendment )' ELSE '' END)"""
AMENDED = "o_orderpriority IN ('1-URGENT', '2-HIGH')"
BASE = f"""o AS (SELECT *, month(o_orderdate) || '.' || (o_custkey % 3) AS section, {AMENDED} AS amended,
  count(*) OVER g AS members, first_value(o_orderkey) OVER newest AS newest_key,
  first_value({AMENDED}) OVER newest AS newest_amended FROM orders
  WINDOW g AS (PARTITION BY o_custkey, month(o_orderdate)),
         newest AS (PARTITION BY o_custkey, month(o_orderdate) ORDER BY o_orderdate DESC, lpad(o_orderkey::VARCHAR, 12, '0') DESC))"""


def as_silver(orders):
    return orders.select(
        F.lpad(F.col("o_orderkey").cast("string"), 12, "0").alias("clause_id"),
        F.concat(F.lit("CTR-"), "o_custkey").alias("contract_id"),
        F.expr(SECTION).alias("section_ref"),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("last_modified"),
        F.lit(None).cast(schemas.REVIEW_HISTORY).alias("review_history"),
        F.lit(None).cast(schemas.LINEAGE).alias("_lineage"),
    )


@query(
    "supersession_candidates",
    f"""WITH {BASE} SELECT 'SUP-' || lpad(o_orderkey::VARCHAR, 12, '0') AS proposal_id, 'CTR-' || o_custkey AS contract_id, section,
  lpad(newest_key::VARCHAR, 12, '0') AS superseding_clause_id, newest_amended AS superseding_marked_amended
FROM o WHERE members > 1 AND o_orderkey <> newest_key""",
)
def _(t):
    found = supersession.proposals(as_silver(t.orders)).where("kind = 'SUPERSESSION_CANDIDATE'")
    return found.select(
        "proposal_id", "contract_id", "section", "superseding_clause_id",
        F.col("evidence.superseding_marked_amended").alias("superseding_marked_amended"),
    )


@query(
    "orphan_amendments",
    f"""WITH {BASE} SELECT 'ORPHAN-' || lpad(o_orderkey::VARCHAR, 12, '0') AS proposal_id, 'CTR-' || o_custkey AS contract_id, section
FROM o WHERE members = 1 AND amended""",
)
def _(t):
    found = supersession.proposals(as_silver(t.orders)).where("kind = 'AMENDS_UNKNOWN_CLAUSE'")
    return found.select("proposal_id", "contract_id", "section")


@query(
    "section_keys",
    f"""SELECT month(o_orderdate) || '.' || (o_custkey % 3) AS section, {AMENDED} AS amended, count(*) AS records
FROM orders GROUP BY ALL""",
)
def _(t):
    ref = F.expr(SECTION)
    return (
        t.orders.groupBy(section_key(ref).alias("section"), is_amendment(ref).alias("amended"))
        .agg(F.count(F.lit(1)).alias("records"))
    )
