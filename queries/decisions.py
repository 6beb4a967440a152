"""The review of the orders corpus: register, escalations, ledger, state read back."""

from pyspark.sql import functions as F

from attestra import schemas
from attestra.functions import cost
from attestra.operators import guardrails, ledger, register, reviews
from attestra.plans import review
from attestra.sources.tables import supersession_map
from queries import query
from queries import texts as x

SETTINGS = review.Settings("run", "2026-01-01T00:00:00.000Z", max_tokens=10**15, max_cost=1e12)


def silver(t):
    text = lambda value: F.lit(value).cast("string")
    return t.spread("orders").select(
        F.expr(x.CLAUSE_ID).alias("clause_id"),
        F.concat(F.lit("CTR-"), "o_custkey").alias("contract_id"),
        text("client").alias("client_name"),
        text(None).alias("section_ref"),
        F.expr(x.SOURCE_CATEGORY).alias("clause_category"),
        F.expr(x.CORPUS).alias("clause_text"),
        F.lit(None).cast(schemas.LINEAGE).alias("_lineage"),
    )


def assessed(t):
    return review.assess(silver(t), SETTINGS)


TOP = "greatest(top, CASE WHEN discretion THEN 2 ELSE 0 END)"
GOLD = f"""g AS (SELECT clause_id, 'CTR-' || o_custkey AS contract_id, source_category, review_category,
  CASE source_category WHEN 'limitation_of_liability' THEN 0.9::DOUBLE WHEN 'security_clearance' THEN 0.5::DOUBLE ELSE 0.95::DOUBLE END AS confidence,
  {x.SEVERITY_NAME}[{TOP} + 1] AS overall_severity, (len(refs) + CASE WHEN discretion THEN 1 ELSE 0 END)::INTEGER AS findings,
  CASE WHEN source_category = 'security_clearance' THEN 'escalated' ELSE 'proposed' END AS status,
  CASE WHEN {TOP} = 3 THEN 'pending' ELSE 'not_required' END AS review_status FROM c)"""


@query("risk_register", f"WITH {x.FINDINGS_CTE}, {GOLD} SELECT * FROM g")
def _(t):
    gold = register.register(silver(t), review.decided_view(assessed(t)))
    return gold.select(
        "clause_id", "contract_id", "source_category", "review_category",
        F.col("classification_confidence").alias("confidence"), "overall_severity",
        F.size("findings").alias("findings"), "status", "review_status",
    )


@query(
    "run_summary",
    f"""WITH {x.FINDINGS_CTE}, {GOLD} SELECT count(*) AS clauses_total, count(*) AS clauses_processed, 0::BIGINT AS clauses_not_processed,
  count(*) FILTER (status = 'escalated') AS escalated, 0::BIGINT AS overridden, count(*) FILTER (overall_severity = 'high') AS severity_high,
  count(*) FILTER (overall_severity = 'medium') AS severity_medium, count(*) FILTER (overall_severity = 'low') AS severity_low,
  count(*) FILTER (overall_severity = 'none') AS severity_none, count(*) FILTER (review_status = 'pending') AS review_pending FROM g""",
)
def _(t):
    return register.run_summary(register.register(silver(t), review.decided_view(assessed(t))))


@query(
    "halted_register",
    f"""WITH {x.FINDINGS_CTE}, u AS (SELECT clause_id, row_number() OVER (ORDER BY clause_id) AS n FROM c)
SELECT CASE WHEN n <= 1000 THEN 'seen' ELSE 'not_processed' END AS state, count(*) AS records, min(clause_id) AS first_clause FROM u GROUP BY 1""",
)
def _(t):
    # 1 token per record and a ceiling of 1,000 tokens: the run halts, every record is accounted for.
    base = silver(t)
    rows = base.select("clause_id", F.lit(1).alias("tokens"), F.lit(0).alias("cost_usd"), F.lit(False).alias("failed"))
    guarded = guardrails.guard_run(rows, ["clause_id"], max_tokens=1000)
    decided = guarded.where("admitted").select(
        "clause_id",
        F.lit("").alias("record_hash"),
        F.lit("other").alias("review_category"),
        F.lit(1.0).alias("classification_confidence"),
        F.lit("rule").alias("classification_decided_by"),
        F.lit(None).cast(f"array<{schemas.FINDING}>").alias("findings"),
        F.lit("none").alias("overall_severity"),
        F.lit("seen").alias("status"),
    )
    gold = register.register(base, decided)
    return gold.groupBy(F.col("status").alias("state")).agg(
        F.count(F.lit(1)).alias("records"), F.min("clause_id").alias("first_clause")
    )


@query(
    "register_collisions",
    """SELECT 'C' || o_custkey AS clause_id, 'h' || o_orderkey AS record_hash,
  CASE WHEN o_orderkey % 3 = 0 THEN 'not_processed' ELSE 'proposed' END AS status,
  CASE WHEN o_orderkey % 3 = 0 THEN 'none' ELSE 'low' END AS overall_severity, 'C' || (o_custkey + 1) AS superseded_by FROM orders""",
)
def _(t):
    """Orders of a customer share an id and are told apart by their hash: every one has one row."""
    key = F.concat(F.lit("C"), "o_custkey")
    record = F.concat(F.lit("h"), "o_orderkey")
    empty = F.lit(None).cast("string")
    lineage = F.struct(
        empty.alias("run_id"), empty.alias("source_file"), empty.alias("source_api_version"),
        F.lit(None).cast("int").alias("record_index"), record.alias("record_hash"), empty.alias("ingested_at"),
    )
    rows = t.orders.select(
        key.alias("clause_id"), empty.alias("contract_id"), empty.alias("client_name"), empty.alias("section_ref"),
        empty.alias("clause_category"), lineage.cast(schemas.LINEAGE).alias("_lineage"),
    )
    decided = t.orders.where("o_orderkey % 3 <> 0").select(
        key.alias("clause_id"), record.alias("record_hash"), empty.alias("review_category"),
        F.lit(None).cast("double").alias("classification_confidence"), empty.alias("classification_decided_by"),
        F.lit(None).cast(f"array<{schemas.FINDING}>").alias("findings"), F.lit("low").alias("overall_severity"),
        F.lit("proposed").alias("status"),
    )
    candidates = t.orders.select(
        F.lit("SUPERSESSION_CANDIDATE").alias("kind"), key.alias("superseded_clause_id"),
        F.concat(F.lit("C"), F.col("o_custkey") + 1).alias("superseding_clause_id"),
    )
    gold = register.register(rows, decided, supersession_map(candidates))
    return gold.select("clause_id", F.col("lineage.record_hash").alias("record_hash"), "status", "overall_severity", "superseded_by")


@query(
    "escalation_queue",
    f"""WITH {x.FINDINGS_CTE} SELECT clause_id, 'clause_classifier' AS agent, 'category_outside_review_taxonomy' AS reason
FROM c WHERE source_category = 'security_clearance'
UNION ALL SELECT 'DOC-' || doc_id, 'scope_guard', CASE WHEN length(text) < 20 THEN 'clause_too_short' ELSE 'clause_too_long' END
FROM documents WHERE length(text) < 20 OR length(text) > 20000
UNION ALL SELECT 'DOC-' || doc_id, 'clause_classifier', 'low_confidence_classification'
FROM documents WHERE length(text) >= 20 AND length(text) <= 20000""",
)
def _(t):
    # Documents carry no source category and no contract wording: they end with a person.
    documents = t.spread("documents").select(
        F.concat(F.lit("DOC-"), "doc_id").alias("clause_id"),
        F.lit("").alias("contract_id"),
        F.lit("").alias("client_name"),
        F.lit(None).cast("string").alias("section_ref"),
        F.lit(None).cast("string").alias("clause_category"),
        F.col("text").alias("clause_text"),
        F.lit(None).cast(schemas.LINEAGE).alias("_lineage"),
    )
    rows = review.assess(silver(t).unionByName(documents), SETTINGS)
    return review.escalation_queue(rows).select("clause_id", "agent", "reason")


@query(
    "decision_ledger",
    f"""WITH {x.FINDINGS_CTE} SELECT 'clause_classifier' AS agent, 'classify_clause' AS action, 'rule' AS decided_by,
  CASE WHEN source_category = 'security_clearance' THEN 'escalated' ELSE 'proposed' END AS status, count(*) AS records FROM c GROUP BY ALL
UNION ALL SELECT 'risk_flagger', 'assess_risk', CASE WHEN review_category IN ('scope_of_work', 'other') THEN 'rule' ELSE 'evidence' END, 'proposed', count(*) FROM c GROUP BY ALL""",
)
def _(t):
    rows = assessed(t).withColumn("processed_before", F.lit(0).cast("bigint"))
    return ledger.counts(review.decision_rows(rows, SETTINGS), "agent", "action", "decided_by", "status")


@query(
    "ledger_latest",
    """SELECT user_id, event_type, max(event_id) AS event_id, arg_max(value, event_id) AS value FROM events GROUP BY ALL""",
)
def _(t):
    rows = t.events.select("user_id", "event_type", "event_id", "value")
    return ledger.latest(rows, ("user_id", "event_type"), ("event_id",))


@query("skip_done", "SELECT doc_id, lang FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def _(t):
    return ledger.skip_done(t.documents.select("doc_id", "lang"), t.labels, "doc_id")


def order_ledger(orders):
    """A customer is a record, its orders are decisions about it; open orders classify."""
    classify = F.col("o_orderstatus") == "O"
    value = F.when(
        classify,
        F.to_json(F.struct(F.col("o_orderpriority").alias("category"), F.lit(0.5).alias("confidence"))),
    ).otherwise(
        F.to_json(
            F.struct(
                F.when(F.col("o_orderpriority") == "1-URGENT", "high").otherwise("low").alias("overall_severity")
            )
        )
    )
    return ledger.ledger_rows(
        orders,
        agent="x",
        action="x",
        clause_id=F.concat(F.lit("C"), "o_custkey"),
        decided_by=F.lit("model"),
        status=F.when(F.col("o_orderpriority") == "5-LOW", "escalated").otherwise("proposed"),
        run_id="r",
        timestamp="t",
        effective_value=value,
        human_decision=F.to_json(F.struct(F.col("o_orderpriority").alias("reviewer"))),
        usage=cost.usage(F.col("o_orderkey"), F.lit(0)),
        seq=F.col("o_orderkey"),
    ).withColumn("action", F.when(F.col("effective_value").contains("category"), "classify_clause").otherwise("assess_risk"))


@query(
    "rehydrate",
    """WITH l AS (SELECT 'C' || o_custkey AS clause_id, o_orderstatus = 'O' AS cls, o_orderpriority AS p, o_orderkey AS seq,
  CASE WHEN o_orderpriority = '5-LOW' THEN 'escalated' ELSE 'proposed' END AS st FROM orders),
a AS (SELECT clause_id, arg_max(p, seq) FILTER (cls) AS category, arg_max(st, seq) FILTER (cls) AS cst,
  arg_max(CASE WHEN p = '1-URGENT' THEN 'high' ELSE 'low' END, seq) FILTER (NOT cls) AS sev, arg_max(st, seq) FILTER (NOT cls) AS ast FROM l GROUP BY 1)
SELECT clause_id, category AS review_category, CASE WHEN category IS NOT NULL THEN 0.5::DOUBLE END AS confidence,
  coalesce(sev, 'none') AS overall_severity, CASE WHEN cst = 'escalated' THEN 'escalated' ELSE coalesce(ast, cst) END AS status FROM a""",
)
def _(t):
    return ledger.rehydrate(order_ledger(t.orders)).select(
        "clause_id", "review_category", F.col("classification_confidence").alias("confidence"),
        "overall_severity", "status",
    )


@query(
    "ledger_append",
    """WITH l AS (SELECT o_orderkey, o_custkey, o_orderstatus = 'O' AS cls, o_orderpriority AS p, year(o_orderdate) < 1999 AS old FROM orders)
SELECT o_orderkey AS seq FROM l n WHERE NOT old AND NOT EXISTS (SELECT 1 FROM l k WHERE k.old AND k.o_custkey = n.o_custkey AND k.cls = n.cls AND k.p = n.p)""",
)
def _(t):
    old = F.year("o_orderdate") < 1999
    known, arriving = order_ledger(t.orders.where(old)), order_ledger(t.orders.where(~old))
    return ledger.not_yet_recorded(arriving, known).select("seq")


@query(
    "repeated_reviews",
    """WITH r AS (SELECT *, year(o_orderdate) < 1996 AS early FROM orders),
n AS (SELECT *, CASE WHEN early THEN 0 ELSE (SELECT count(*) FROM r WHERE early) END
  + row_number() OVER (PARTITION BY early ORDER BY o_orderkey) AS seq FROM r)
SELECT 'OVR-C' || (o_custkey % 50) || '-' || printf('%02d', seq) AS override_id, o_orderkey::VARCHAR AS rationale, seq::BIGINT AS seq,
  true AS recorded FROM n""",
)
def _(t):
    """Two runs over the reviews of few people: the second sees all reviews again.  Ids of the first stay, and
    every review of the same reviewer on the same record is a ledger row of its own."""
    text = lambda value: F.lit(value).cast("string")
    met = t.orders.select(
        F.concat(F.lit("C"), F.col("o_custkey") % 50).alias("clause_id"), F.lit("ann").alias("reviewer"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"), F.lit("accept").alias("action"),
        F.concat(F.lit("risk.findings.f"), "o_orderkey").alias("field"), text(None).alias("human_value"),
        F.col("o_orderkey").cast("string").alias("rationale"), F.lit("simulated").alias("source"), F.lit(1).alias("_source"),
        F.lit("").alias("_key"), F.col("o_orderkey").alias("_pos"), F.lit(None).cast(f"array<{schemas.FINDING}>").alias("findings"),
        F.lit("high").alias("model_value"), F.lit("override").alias("outcome"), text(None).alias("inferred_field"),
        (F.year("o_orderdate") < 1996).alias("early"),
    )
    first = reviews.overrides(met.where("early"))
    second = reviews.overrides(met, recorded=first)
    known = reviews.review_ledger_rows(met.limit(0), first, "one", "t")
    kept = ledger.not_yet_recorded(reviews.review_ledger_rows(met.limit(0), first.unionByName(second), "two", "t"), known)
    rows = known.unionByName(kept).select(F.get_json_object("human_decision", "$.override_id").alias("override_id"), F.lit(True).alias("recorded"))
    return first.unionByName(second).select("override_id", "rationale", "seq").join(rows, "override_id")


@query("ledger_counts", "SELECT event_type AS agent, count(*) AS records FROM events GROUP BY 1")
def _(t):
    return ledger.counts(t.events.select(F.col("event_type").alias("agent")), "agent")


@query(
    "completed_records",
    "SELECT DISTINCT 'C' || o_custkey AS clause_id FROM orders WHERE o_orderstatus <> 'O'",
)
def _(t):
    return ledger.completed(order_ledger(t.orders)).select("clause_id")


@query(
    "health_signals",
    """SELECT count(*) AS decisions, round(avg(CASE WHEN event_type = 'click' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 4) AS rule_share,
  round(avg(CASE WHEN event_type = 'signup' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 4) AS human_share,
  round(sum(round(event_id * 3 / 1000000.0::DOUBLE, 8)::DECIMAL(28,8))::DOUBLE / count(DISTINCT user_id), 8) AS cost_per_record FROM events""",
)
def _(t):
    rows = t.events.select(
        F.col("user_id").alias("clause_id"),
        F.when(F.col("event_type") == "click", "rule").when(F.col("event_type") == "signup", "human").otherwise("model").alias("decided_by"),
        cost.usage(F.col("event_id"), F.lit(0)).alias("usage"),
    )
    return register.health_signals(rows)
