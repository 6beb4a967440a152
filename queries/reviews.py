"""Human reviews of the orders corpus: dispositions, overrides, proposals."""

from pyspark.sql import functions as F

from attestra import schemas
from attestra.operators import learning, register, reviews, rules
from attestra.operators.policy import BASELINE
from queries import query
from queries import texts as x
from queries.rules import findings


def with_history(t):
    """Finished orders were flagged, open ones approved (reviewer and notes missing), half-finished
    ones approved and then expanded."""

    def one(reviewer, action, notes):
        text = lambda v: F.lit(v).cast("string")
        return F.struct(
            text(reviewer).alias("reviewer"), text("2026-01-01").alias("date"), text(action).alias("action"), text(notes).alias("notes")
        )

    status = F.col("o_orderstatus")
    entries = (
        F.when(status == "F", F.array(one("A", "flagged", "look")))
        .when(status == "O", F.array(one(None, "approved", None)))
        .otherwise(F.array(one("B", "approved", "fine"), one("C", "expanded", "more")))
    )
    return t.orders.select(
        F.expr(x.CLAUSE_ID).alias("clause_id"),
        F.struct(entries.alias("reviews"), F.size(entries).alias("review_count"), F.lit(None).cast("string").alias("last_review_date"))
        .cast(schemas.REVIEW_HISTORY)
        .alias("review_history"),
    )


def simulated(t):
    return t.orders.where("o_orderpriority = '2-HIGH'").select(
        F.expr(x.CLAUSE_ID).alias("clause_id"),
        F.lit("S").alias("reviewer"),
        F.lit("2026-01-02").alias("date"),
        F.lit("override").alias("action"),
        F.lit(None).cast("string").alias("field"),
        F.lit("waived").alias("human_value"),
        F.lit("priced in").alias("rationale"),
        F.col("o_orderkey").alias("position"),
    )


def all_reviews(t):
    return reviews.human_reviews(with_history(t), simulated(t))


def assessments(t):
    return findings(t).select(
        "clause_id",
        "findings",
        "overall_severity",
        F.when(F.col("review_category") == "other", "escalated").otherwise("proposed").alias("risk_status"),
    )


def reconciled(t):
    return reviews.reconcile(all_reviews(t), assessments(t))


REVIEWS = f"""{x.FINDINGS_CTE}, r AS (
  SELECT clause_id, 'A' AS reviewer, 'flagged' AS action, 'look' AS rationale, 'review_history' AS source, 0 AS src, 0 AS pos, 'accepted' AS human_value FROM c WHERE o_orderstatus = 'F'
  UNION ALL SELECT clause_id, 'unknown', 'approved', '', 'review_history', 0, 0, 'accepted' FROM c WHERE o_orderstatus = 'O'
  UNION ALL SELECT clause_id, 'B', 'approved', 'fine', 'review_history', 0, 0, 'accepted' FROM c WHERE o_orderstatus = 'P'
  UNION ALL SELECT clause_id, 'C', 'expanded', 'more', 'review_history', 0, 1, 'accepted' FROM c WHERE o_orderstatus = 'P'
  UNION ALL SELECT clause_id, 'S', 'override', 'priced in', 'simulated', 1, o_orderkey, 'waived' FROM c WHERE o_orderpriority = '2-HIGH'),
d AS (SELECT r.*, c.refs, c.top, c.review_category, CASE WHEN action IN ('flagged', 'expanded') THEN 'confirmation'
    WHEN review_category <> 'other' AND top >= 2 THEN 'override' END AS outcome FROM r JOIN c USING (clause_id)),
v AS (SELECT *, row_number() OVER (ORDER BY src, CASE WHEN src = 0 THEN clause_id ELSE '' END, pos, clause_id) AS seq FROM d WHERE outcome = 'override'),
o AS (SELECT 'OVR-' || clause_id || '-' || CASE WHEN seq < 10 THEN '0' || seq ELSE seq::VARCHAR END AS override_id, clause_id, reviewer,
  'risk.findings.' || refs[1] AS field, {x.SEVERITY_NAME}[top + 1] AS model_value, human_value, source, rationale, seq FROM v)"""


@query("human_reviews", f"WITH {REVIEWS} SELECT clause_id, reviewer, action, rationale, source, pos::BIGINT AS pos FROM r")
def _(t):
    return all_reviews(t).select("clause_id", "reviewer", "action", "rationale", "source", F.col("_pos").alias("pos"))


@query(
    "review_dispositions",
    f"WITH {REVIEWS} SELECT action, review_category, coalesce(outcome, 'none') AS outcome, count(*) AS reviews FROM d GROUP BY ALL",
)
def _(t):
    found = reconciled(t).join(findings(t).select("clause_id", "review_category"), "clause_id")
    return found.groupBy("action", "review_category", F.coalesce("outcome", F.lit("none")).alias("outcome")).agg(
        F.count(F.lit(1)).alias("reviews")
    )


@query(
    "overrides",
    f"WITH {REVIEWS} SELECT override_id, clause_id, reviewer, field, model_value, human_value, source, seq FROM o",
)
def _(t):
    return reviews.overrides(reconciled(t)).select(
        "override_id", "clause_id", "reviewer", "field", "model_value", "human_value", "source", "seq"
    )


@query(
    "review_ledger",
    f"""WITH {REVIEWS} SELECT 'human_confirmation' AS action, 'accepted' AS status, reviewer, count(*) AS records FROM d WHERE outcome = 'confirmation' GROUP BY ALL
UNION ALL SELECT 'human_override', 'overridden', reviewer, count(*) FROM d WHERE outcome = 'override' GROUP BY ALL""",
)
def _(t):
    met = reconciled(t)
    rows = reviews.review_ledger_rows(met, reviews.overrides(met), "run", "2026-01-01T00:00:00.000Z")
    return rows.groupBy("action", "status", F.get_json_object("human_decision", "$.reviewer").alias("reviewer")).agg(
        F.count(F.lit(1)).alias("records")
    )


@query(
    "effective_view",
    f"""WITH {REVIEWS}, a AS (SELECT clause_id, arg_max(override_id, seq) AS overridden_by FROM o GROUP BY 1)
SELECT CASE WHEN overridden_by IS NULL THEN {x.SEVERITY_NAME}[top + 1] ELSE 'low' END AS overall_severity,
  CASE WHEN overridden_by IS NOT NULL THEN 'overridden' WHEN review_category = 'other' THEN 'escalated' ELSE 'proposed' END AS status,
  CASE WHEN overridden_by IS NOT NULL THEN 'resolved_by_override' WHEN top = 3 THEN 'pending' ELSE 'not_required' END AS review_status,
  count(*) AS records FROM c LEFT JOIN a USING (clause_id) GROUP BY ALL""",
)
def _(t):
    rows = assessments(t)
    found = reviews.overrides(reviews.reconcile(all_reviews(t), rows))
    view = reviews.with_overrides(
        rows.withColumn("status", F.col("risk_status")).withColumn(
            "review_status", F.when(F.col("overall_severity") == "high", "pending").otherwise("not_required")
        ),
        found,
    )
    return view.groupBy("overall_severity", "status", "review_status").agg(F.count(F.lit(1)).alias("records"))


PROPOSED = "p AS (SELECT substr(field, 15) AS ref, count(*) AS occurrences FROM o GROUP BY 1 HAVING count(*) >= 2)"
VALUE = """CASE ref WHEN 'payment_terms.max_days_to_pay' THEN '30' WHEN 'termination.min_notice_days_for_convenience' THEN '30'
  WHEN 'insurance.max_professional_liability_per_claim_usd' THEN '5000000' WHEN 'liability.max_cap_multiple_of_fees' THEN '1.0'
  WHEN 'indemnification.must_be_limited_to_own_negligence' THEN 'true' ELSE 'false' END"""
LP = "'LP-' || split_part(ref, '.', 1) || '-' || split_part(ref, '.', 2)"


def proposals(t, found):
    return learning.learning_proposals(found, BASELINE.to_rows(t.spark), "2026-01-01T00:00:00.000Z")


@query(
    "learning_proposals",
    f"""WITH {REVIEWS}, {PROPOSED} SELECT {LP} AS proposal_id, 'PENDING_HUMAN_APPROVAL' AS status, occurrences, {VALUE} AS current_value,
  'Reviewers overrode ''' || ref || ''' on ' || occurrences || ' clauses. The standard may be too absolute.' AS summary FROM p""",
)
def _(t):
    return proposals(t, reviews.overrides(reconciled(t))).select(
        "proposal_id", "status", "occurrences", "current_value", "summary"
    )


@query(
    "proposal_evidence",
    f"""WITH {REVIEWS}, {PROPOSED} SELECT {LP} AS proposal_id, seq, override_id,
  'Reviewed and accepted on ' || clause_id || ' by ' || reviewer || ': ' || rationale AS exception
FROM o JOIN p ON substr(field, 15) = ref""",
)
def _(t):
    found = reviews.overrides(reconciled(t))
    return learning.proposal_evidence(found, proposals(t, found)).select(
        "proposal_id", "seq", "override_id", "exception"
    )


@query(
    "policy_diff",
    f"""WITH {REVIEWS}, {PROPOSED} SELECT ref AS standard_reference, 'value' AS field, {VALUE} AS before, {VALUE} AS after FROM p
UNION ALL SELECT ref, 'exceptions', NULL, 'Reviewed and accepted on ' || clause_id || ' by ' || reviewer || ': ' || rationale
FROM o JOIN p ON substr(field, 15) = ref""",
)
def _(t):
    found = reviews.overrides(reconciled(t))
    offered = proposals(t, found)
    return learning.policy_diff(BASELINE.to_rows(t.spark), offered, learning.proposal_evidence(found, offered)).select(
        "standard_reference", "field", "before", "after"
    )


APPLIED = "LP-payment_terms-max_days_to_pay"


@query(
    "applied_policy",
    f"""WITH {REVIEWS} SELECT '1.1.0' AS version, 'payment_terms' AS section, 'max_days_to_pay' AS key,
  'Reviewed and accepted on ' || clause_id || ' by ' || reviewer || ': ' || rationale AS text FROM o
WHERE field = 'risk.findings.payment_terms.max_days_to_pay'""",
)
def _(t):
    found = reviews.overrides(reconciled(t))
    offered = proposals(t, found)
    applied = learning.apply_proposal(
        BASELINE.to_rows(t.spark), offered, learning.proposal_evidence(found, offered), APPLIED, "A. Person", "agreed",
        "2026-01-02T00:00:00.000Z",
    )
    return applied["exceptions"].select("version", "section", "key", "text")


@query(
    "approval_record",
    f"""WITH {REVIEWS} SELECT 'APR-{APPLIED}' AS approval_id, 'A. Person' AS approved_by, '1.0.0' AS version_from, '1.1.0' AS version_to,
  count(*) AS occurrences FROM o WHERE field = 'risk.findings.payment_terms.max_days_to_pay'""",
)
def _(t):
    found = reviews.overrides(reconciled(t))
    offered = proposals(t, found)
    applied = learning.apply_proposal(
        BASELINE.to_rows(t.spark), offered, learning.proposal_evidence(found, offered), APPLIED, "A. Person", "agreed",
        "2026-01-02T00:00:00.000Z",
    )
    return applied["approvals"].select("approval_id", "approved_by", "version_from", "version_to", "occurrences")


@query(
    "override_rates",
    f"""WITH {REVIEWS}, raised AS (SELECT unnest(refs) AS ref FROM c), n AS (SELECT ref, count(*) AS raised FROM raised GROUP BY 1),
w AS (SELECT substr(field, 15) AS ref, count(*) AS overruled FROM o GROUP BY 1)
SELECT ref AS standard_reference, raised, coalesce(overruled, 0) AS overruled, round(coalesce(overruled, 0) / raised, 4) AS override_rate
FROM n LEFT JOIN w USING (ref)""",
)
def _(t):
    return register.override_rate(rules.exploded(findings(t)), reviews.overrides(reconciled(t)))
