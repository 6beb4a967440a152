"""Policy rules over clause texts; precedents; keyword evidence."""

from pyspark.sql import functions as F

from attestra import fixed_values as fixed
from attestra.functions import numbers, severity
from attestra.functions.text import keyword_evidence
from attestra.operators import classify, precedents, residue, rules
from attestra.operators.policy import BASELINE
from queries import query
from queries import texts as x

LINE = "l_orderkey, l_linenumber, l_partkey, l_suppkey"


def lines(t, text, category):
    return t.spread("lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.expr(text).alias("clause_text"), F.lit(category).alias("review_category"),
    )


def orders(t, text, category):
    return t.spread("orders").select(
        "o_orderkey", F.expr(text).alias("clause_text"), F.lit(category).alias("review_category")
    )


def found(rows, reference, *keys):
    """Rows where one rule fires, with what it saw."""
    hits = rules.exploded(rules.with_findings(rows), *keys)
    return hits.where(F.col("standard_reference") == reference).select(*keys, "observed", "severity")


def line_rule(name, text, category, key, condition, observed, level):
    reference = f"{category}.{key}"
    sql = f"SELECT {LINE}, {observed} AS observed, '{level}' AS severity FROM lineitem WHERE {condition}"
    query(name, sql)(
        lambda t: found(lines(t, text, category), reference, "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    )


def order_rule(name, text, category, key, condition, observed, level):
    reference = f"{category}.{key}"
    sql = f"SELECT o_orderkey, {observed} AS observed, '{level}' AS severity FROM orders WHERE {condition}"
    query(name, sql)(lambda t: found(orders(t, text, category), reference, "o_orderkey"))


URGENT, HIGH, LOW = "o_orderpriority = '1-URGENT'", "o_orderpriority = '2-HIGH'", "o_orderpriority = '5-LOW'"
order_rule(
    "rule_own_negligence", x.INDEMNITY, "indemnification", "must_be_limited_to_own_negligence",
    f"({URGENT} OR {HIGH}) AND o_orderstatus <> 'F'", "'indemnity applies regardless of the Owner''s negligence'", "high",
)
order_rule(
    "rule_duty_to_defend", x.INDEMNITY, "indemnification", "duty_to_defend_permitted",
    f"{HIGH} OR {LOW}", "'duty to defend present'", "high",
)
order_rule(
    "rule_fullest_extent", x.INDEMNITY, "indemnification", "fullest_extent_permitted_by_law_permitted",
    f"o_orderpriority = '4-NOT SPECIFIED' OR {LOW}", "'''to the fullest extent permitted by law'''", "medium",
)
order_rule(
    "rule_open_ended_scope", x.SCOPE, "scope_of_work", "open_ended_scope_language_permitted",
    f"{URGENT} OR {HIGH} OR o_orderpriority = '3-MEDIUM'",
    "CASE o_orderpriority WHEN '1-URGENT' THEN '''including but not limited to''' WHEN '2-HIGH' THEN '''as may be required''' ELSE '''and all related services''' END",
    "medium",
)
# Only the word next to "times" counts: "forty-five times" reads as five.
NEXT_WORD = "CASE WHEN l_linenumber < 7 THEN l_linenumber ELSE 5 END"
CAP = f"""CASE WHEN l_returnflag = 'N' AND l_linestatus = 'F' THEN 1.0 WHEN l_returnflag = 'N' THEN {NEXT_WORD}
 WHEN l_returnflag = 'A' THEN {x.PERCENT} + 0.25 END"""
line_rule(
    "rule_cap_multiple", x.LIABILITY, "liability", "max_cap_multiple_of_fees", f"{CAP} > 1",
    f"CASE WHEN l_returnflag = 'N' THEN ({NEXT_WORD})::VARCHAR ELSE {x.PERCENT} || '.25' END || 'x total fees'", "high",
)
line_rule(
    "rule_days_to_pay", x.PAYMENT, "payment_terms", "max_days_to_pay", f"{x.QTY} > 30", f"{x.QTY} || ' days'", "medium",
)
line_rule(
    "rule_retainage", x.PAYMENT, "payment_terms", "max_retainage_percent",
    f"(l_linenumber < 4 AND {x.PERCENT} > 5) OR (l_linenumber = 4 AND {x.PERCENT} + 0.5 > 5)",
    f"CASE WHEN l_linenumber = 4 THEN {x.PERCENT} || '.5' ELSE {x.PERCENT}::VARCHAR END || '% retainage'", "medium",
)
line_rule(
    "rule_discretionary_withholding", x.PAYMENT, "payment_terms", "discretionary_withholding_permitted",
    "l_returnflag = 'R'", "'unilateral right to withhold pending ''any disputes'''", "high",
)
line_rule(
    "rule_late_interest", x.PAYMENT, "payment_terms", "late_interest_required",
    "l_returnflag <> 'A'", "'no late-payment interest term'", "low",
)
NOTICE = f"({x.QTY} + l_linenumber * 4)"
line_rule(
    "rule_notice_days", x.TERMINATION, "termination", "min_notice_days_for_convenience",
    f"l_returnflag <> 'R' AND {NOTICE} < 30", f"{NOTICE} || ' days'' notice'", "medium",
)
line_rule(
    "rule_demobilisation", x.TERMINATION, "termination", "demobilisation_costs_recoverable",
    "l_returnflag <> 'R' AND l_linestatus = 'O' AND l_linenumber <= 4", "'compensation limited to services performed'", "medium",
)
line_rule(
    "rule_per_claim_cover", x.INSURANCE, "insurance", "max_professional_liability_per_claim_usd",
    f"CASE WHEN l_linestatus = 'O' THEN {x.QTY} + 0.25 ELSE {x.QTY} END > 5",
    f"'$' || {x.QTY} || CASE WHEN l_linestatus = 'O' THEN ',250,000' ELSE ',000,000' END || ' per claim'", "medium",
)
TAIL = f"CASE WHEN l_returnflag = 'R' THEN {x.QTY} WHEN l_returnflag = 'A' THEN {x.WORD_VALUE} END"
line_rule(
    "rule_tail_years", x.INSURANCE, "insurance", "max_tail_years_after_completion", f"{TAIL} > 3",
    f"{TAIL} || ' years'", "medium",
)


@query(
    "nearest_days",
    f"""SELECT {LINE}, CASE WHEN l_returnflag <> 'R' THEN {NOTICE}::BIGINT END AS near, {x.QTY} AS first FROM lineitem""",
)
def _(t):
    lowered = F.lower("clause_text")
    return lines(t, x.TERMINATION, "termination").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        numbers.nearest_days(lowered, fixed.CONVENIENCE_WORD).cast("bigint").alias("near"),
        numbers.first_days(lowered).cast("bigint").alias("first"),
    )


def corpus(t):
    return t.spread("orders").select(
        F.expr(x.CLAUSE_ID).alias("clause_id"),
        F.expr(x.CORPUS).alias("clause_text"),
        F.expr(x.SOURCE_CATEGORY).alias("clause_category"),
        F.expr(x.REVIEW_CATEGORY).alias("review_category"),
    )


def findings(t):
    return rules.with_severity(rules.with_findings(corpus(t)))


@query(
    "findings_by_standard",
    f"""WITH {x.FINDINGS_CTE}, e AS (SELECT unnest(refs) AS ref FROM c)
SELECT ref AS standard_reference, {x.SEVERITY_OF} AS severity, count(*) AS findings FROM e GROUP BY ALL""",
)
def _(t):
    return rules.findings_by_standard(findings(t))


@query(
    "overall_severity",
    f"WITH {x.FINDINGS_CTE} SELECT {x.SEVERITY_NAME}[top + 1] AS overall_severity, count(*) AS records FROM c GROUP BY 1",
)
def _(t):
    return rules.severity_counts(findings(t))


@query(
    "rule_findings_per_record",
    f"""WITH {x.FINDINGS_CTE} SELECT clause_id, array_to_string(refs, ';') AS standards,
  {x.SEVERITY_NAME}[top + 1] AS overall_severity FROM c""",
)
def _(t):
    return findings(t).select(
        "clause_id",
        F.array_join(F.transform("findings", lambda f: f["standard_reference"]), ";").alias("standards"),
        "overall_severity",
    )


@query(
    "stricter_policy",
    f"""SELECT l_returnflag, l_linestatus, count(*) AS findings FROM lineitem WHERE {x.QTY} > 10 GROUP BY ALL""",
)
def _(t):
    policy = BASELINE.with_value("payment_terms.max_days_to_pay", 10)
    rows = t.spread("lineitem").select(
        "l_returnflag", "l_linestatus", F.expr(x.PAYMENT).alias("clause_text"), F.lit("payment_terms").alias("review_category")
    )
    hits = rules.exploded(rules.with_findings(rows, policy), "l_returnflag", "l_linestatus")
    return (
        hits.where("standard_reference = 'payment_terms.max_days_to_pay'")
        .groupBy("l_returnflag", "l_linestatus")
        .agg(F.count(F.lit(1)).alias("findings"))
    )


@query(
    "clean_records",
    f"WITH {x.FINDINGS_CTE} SELECT review_category AS category, count(*) AS clean_records FROM c WHERE len(refs) = 0 GROUP BY 1",
)
def _(t):
    return precedents.clean_counts(precedents.clean_index(findings(t)))


@query(
    "precedents",
    f"""WITH {x.FINDINGS_CTE}, first AS (SELECT review_category, list(clause_id ORDER BY clause_id)[1:4] AS ids
  FROM c WHERE len(refs) = 0 GROUP BY 1)
SELECT clause_id, unnest(refs) AS standard_reference, coalesce(array_to_string(list_filter(ids, lambda i: i <> clause_id)[1:3], ','), '') AS precedents
FROM c LEFT JOIN first USING (review_category)""",
)
def _(t):
    rows = findings(t)
    cited = precedents.with_precedents(rows, precedents.first_clean(precedents.clean_index(rows)))
    return rules.exploded(cited, "clause_id").select(
        "clause_id", "standard_reference", F.array_join("precedent_clause_ids", ",").alias("precedents")
    )


# Stop words stand in for category keywords: the documents are prose, not contracts.
LANGUAGES = (
    ("fr", (" le ", " la ", " qui ", " dans ", " des ")),
    ("en", (" the ", " of ", " and ", " that ", " is ")),
    ("de", (" der ", " die ", " und ", " das ", " ist ")),
    ("es", (" el ", " los ", " que ", " por ", " una ")),
)


def keyword_sql(table, key, text, categories, other="other"):
    hits = ",\n".join(
        f"[{', '.join(f'CASE WHEN contains(lower({text}), {w!r}) THEN {w!r} END' for w in words)}] AS h{i}"
        for i, (_n, words) in enumerate(categories)
    )
    sizes = ", ".join(f"len(list_filter(h{i}, lambda z: z IS NOT NULL))" for i in range(len(categories)))
    names = ", ".join(f"'{n}'" for n, _w in categories)
    return f"""WITH h AS (SELECT {key}, {hits} FROM {table}), n AS (SELECT {key}, [{sizes}] AS sizes FROM h)
SELECT {key}, CASE WHEN list_max(sizes) = 0 THEN '{other}' ELSE [{names}][list_position(sizes, list_max(sizes))] END AS category,
  CASE WHEN list_max(sizes) = 0 THEN 0.35::DOUBLE ELSE round(least(0.95::DOUBLE, 0.55::DOUBLE + 0.12::DOUBLE * list_max(sizes)), 2) END AS confidence,
  list_max(sizes)::INTEGER AS signals FROM n"""


def keyword_rows(rows, key, text, categories):
    evidence = rows.select(key, F.lower(text).alias("_t")).select(key, keyword_evidence(F.col("_t"), categories).alias("e"))
    return evidence.select(key, "e.category", "e.confidence", F.size("e.signals").alias("signals"))


@query("keyword_language", keyword_sql("documents", "doc_id", "text", LANGUAGES))
def _(t):
    return keyword_rows(t.spread("documents"), "doc_id", "text", LANGUAGES)


TAGS = (
    ("table", ("<table", "<td", "<tr")),
    ("script", ("<script", "<style")),
    ("list", ("<ul", "<li", "<ol")),
    ("text", ("<p", "<h1", "<div", "<title")),
)


@query("keyword_pages", keyword_sql("pages", "page_id", "html", TAGS))
def _(t):
    return keyword_rows(t.spread("pages"), "page_id", "html", TAGS)


@query("keyword_category", keyword_sql(f"(SELECT o_orderkey, {x.CORPUS} AS txt FROM orders)", "o_orderkey", "txt", fixed.CATEGORY_KEYWORDS))
def _(t):
    rows = t.spread("orders").select("o_orderkey", F.expr(x.CORPUS).alias("txt"))
    return keyword_rows(rows, "o_orderkey", "txt", fixed.CATEGORY_KEYWORDS)


@query(
    "classification",
    f"""SELECT o_orderkey, {x.REVIEW_CATEGORY} AS category,
  CASE {x.SOURCE_CATEGORY} WHEN 'limitation_of_liability' THEN 0.9::DOUBLE WHEN 'security_clearance' THEN 0.5::DOUBLE ELSE 0.95::DOUBLE END AS confidence,
  'rule' AS decided_by, CASE {x.SOURCE_CATEGORY} WHEN 'security_clearance' THEN 'escalated' ELSE 'proposed' END AS status,
  CASE {x.SOURCE_CATEGORY} WHEN 'security_clearance' THEN 'category_outside_review_taxonomy' END AS reason FROM orders""",
)
def _(t):
    rows = t.spread("orders").select(
        "o_orderkey", F.expr(x.SOURCE_CATEGORY).alias("clause_category"), F.expr(x.CORPUS).alias("clause_text")
    )
    return classify.classify(rows).select(
        "o_orderkey", "classification.category", "classification.confidence",
        F.col("class_decided_by").alias("decided_by"), F.col("class_status").alias("status"),
        F.col("class_reason").alias("reason"),
    )


@query(
    "residue_findings",
    f"""WITH {x.FINDINGS_CTE} SELECT clause_id, CASE WHEN discretion THEN 'medium' WHEN fault THEN 'high' ELSE 'none' END AS overall_severity,
  CASE WHEN discretion OR fault THEN 0.7::DOUBLE ELSE 0.85::DOUBLE END AS confidence,
  (CASE WHEN discretion OR fault THEN 1 ELSE 0 END)::INTEGER AS findings FROM c""",
)
def _(t):
    found_here = corpus(t).select("clause_id", residue.narrative_assessment(F.lower("clause_text")).alias("a"))
    return found_here.select("clause_id", "a.overall_severity", "a.confidence", F.size("a.findings").alias("findings"))


@query(
    "merged_findings",
    f"""WITH {x.FINDINGS_CTE} SELECT clause_id, (len(refs) + CASE WHEN discretion THEN 1 ELSE 0 END)::INTEGER AS findings,
  (CASE WHEN fault THEN 1 ELSE 0 END)::INTEGER AS dropped_findings,
  {x.SEVERITY_NAME}[greatest(top, CASE WHEN discretion THEN 2 ELSE 0 END) + 1] AS overall_severity,
  CASE WHEN discretion THEN 0.7::DOUBLE ELSE 1.0::DOUBLE END AS risk_confidence,
  CASE WHEN review_category IN ('scope_of_work', 'other') THEN 'rule' ELSE 'evidence' END AS risk_decided_by,
  greatest(top, CASE WHEN discretion THEN 2 ELSE 0 END) >= 3 AS review_required FROM c""",
)
def _(t):
    merged = residue.merge_assessment(
        findings(t), residue.narrative_assessment(F.lower("clause_text")), classify.risk_bearing(F.col("review_category")),
        model_decided_by=F.lit("evidence"),
    )
    return merged.select(
        "clause_id", F.size("findings").alias("findings"), "dropped_findings", "overall_severity", "risk_confidence",
        "risk_decided_by", classify.review_required(F.col("overall_severity")).alias("review_required"),
    )


@query(
    "model_output_parsing",
    """WITH p AS (SELECT conv_id, turn, role,
  CASE role WHEN 'user' THEN CASE WHEN turn = 0 THEN 'liability' ELSE 'insurance' END END AS category FROM conversations)
SELECT conv_id, turn, role, category IS NOT NULL AS usable, category, CASE WHEN category IS NOT NULL THEN 0.25 * turn / 2 END AS confidence FROM p""",
)
def _(t):
    # User turns answer with valid JSON (every second one fenced), the assistant with plain text,
    # the system with JSON that names an unknown category.
    good = F.to_json(
        F.struct(
            F.when(F.col("turn") == 0, "liability").otherwise("insurance").alias("category"),
            (F.lit(0.25) * F.col("turn") / 2).alias("confidence"),
            F.col("text").alias("reasoning"),
        )
    )
    content = (
        F.when((F.col("role") == "user") & (F.col("turn") == 2), F.concat(F.lit("```json\n"), good, F.lit("\n```")))
        .when(F.col("role") == "user", good)
        .when(F.col("role") == "system", F.regexp_replace(good, '"(liability|insurance)"', '"weather"'))
        .otherwise(F.col("text"))
    )
    parsed = t.spread("conversations").select("conv_id", "turn", "role", residue.parse_classification(content).alias("p"))
    return parsed.select(
        "conv_id", "turn", "role", F.col("p").isNotNull().alias("usable"), "p.category", "p.confidence"
    )


@query(
    "severity_ranks",
    """SELECT quality, toxic, ['none','low','medium','high'][quality + 2 * toxic + 1] AS severity, (quality + 2 * toxic)::INTEGER AS rank, count(*) AS records
FROM labels GROUP BY ALL""",
)
def _(t):
    named = severity.name(F.col("quality") + 2 * F.col("toxic"))
    return (
        t.labels.select("quality", "toxic", named.alias("severity"))
        .withColumn("rank", severity.rank(F.col("severity")))
        .groupBy("quality", "toxic", "severity", "rank")
        .agg(F.count(F.lit(1)).alias("records"))
    )
