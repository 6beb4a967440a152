"""Clause texts written from the numbers in the tables.

Every expression is plain SQL that both engines read, so the text is the same on both sides; the
expected findings are then worked out from the numbers, not from the text.
"""

WORD = "CASE l_linenumber WHEN 1 THEN 'one' WHEN 2 THEN 'two' WHEN 3 THEN 'three' WHEN 4 THEN 'four' WHEN 5 THEN 'five' WHEN 6 THEN 'six' ELSE 'forty-five' END"
WORD_VALUE = "CASE WHEN l_linenumber < 7 THEN l_linenumber ELSE 45 END"
QTY = "CAST(l_quantity AS BIGINT)"
PERCENT = "CAST(round(l_discount * 100) AS BIGINT)"

PAYMENT = f"""concat('Payment shall be made within some (', CAST({QTY} AS STRING),
 CASE l_linestatus WHEN 'O' THEN ') calendar days' ELSE ') days' END, ' of receipt of an invoice. ',
 CASE WHEN l_linenumber < 4 THEN concat('The Owner keeps up to ', CAST({PERCENT} AS STRING), '% of each invoice as retainage. ')
      WHEN l_linenumber = 4 THEN concat('The Owner may withhold an extra ', CAST({PERCENT} AS STRING), '.5% of it. ')
      ELSE '' END,
 CASE l_returnflag WHEN 'R' THEN 'The Owner may withhold payment pending any dispute.'
      WHEN 'A' THEN 'Late amounts bear INTEREST.' ELSE 'Nothing else applies.' END)"""

LIABILITY = f"""CASE WHEN l_returnflag = 'N' AND l_linestatus = 'F' THEN 'Liability shall not exceed the total fees paid.'
 WHEN l_returnflag = 'N' THEN concat('Liability shall be limited to ', {WORD}, ' times the total fees paid.')
 WHEN l_returnflag = 'A' THEN concat('Liability shall not exceed a multiple (', CAST({PERCENT} AS STRING), '.25x) of the total fees.')
 ELSE concat('Liability is ', {WORD}, ' times the total fees.') END"""

TERMINATION = f"""concat('Either party may end this for cause upon (', CAST({QTY} AS STRING), ') days notice if the other fails to cure a breach. ',
 CASE WHEN l_returnflag = 'R' THEN 'Nothing more is agreed.'
      ELSE concat('The Owner may end it for convenience upon (', CAST({QTY} + l_linenumber * 4 AS STRING), ') days notice',
        CASE WHEN l_linestatus = 'O' THEN ' with no additional compensation' ELSE '' END,
        CASE WHEN l_linenumber > 4 THEN ' beyond demobilization costs.' ELSE '.' END) END)"""

INSURANCE = f"""concat('The Designer carries Professional Liability Insurance ',
 CASE WHEN l_linestatus = 'O' THEN concat('with a minimum of $', CAST({QTY} AS STRING), ',250,000 per claim')
      ELSE concat('of $', CAST({QTY} AS STRING), ',000,000 in total') END,
 ' and keeps it for ', CASE WHEN l_returnflag = 'R' THEN CAST({QTY} AS STRING) WHEN l_returnflag = 'A' THEN {WORD} ELSE 'some' END,
 ' years following completion.')"""

SCOPE = """concat('The Designer provides services ', CASE o_orderpriority WHEN '1-URGENT' THEN 'including but not limited to drawings'
 WHEN '2-HIGH' THEN 'as may be required and ALL related services, and all related services' WHEN '3-MEDIUM' THEN 'And all related services' ELSE 'listed in Exhibit A' END, '.')"""

INDEMNITY = """concat(CASE o_orderpriority
  WHEN '1-URGENT' THEN 'The Designer shall indemnify the Owner regardless of the Owner''s negligence'
  WHEN '2-HIGH' THEN 'The Designer shall defend and indemnify the Owner even when caused in part by the owner negligence'
  WHEN '3-MEDIUM' THEN 'The Designer is defending its work'
  WHEN '4-NOT SPECIFIED' THEN 'The Designer shall defend the Owner, to the Fullest Extent Permitted by Law'
  ELSE 'Indemnification is owed and the Designer will defend, to the fullest extent permitted by law' END, '. ',
 CASE o_orderstatus WHEN 'F' THEN 'This shall not apply to the Owner''s sole negligence.'
  WHEN 'O' THEN 'Neither party shall be required to insure the other.' ELSE '' END)"""

# One corpus of all categories, one record per order.
SOURCE_CATEGORY = """CASE o_orderpriority WHEN '1-URGENT' THEN 'indemnification' WHEN '2-HIGH' THEN 'payment_terms'
 WHEN '3-MEDIUM' THEN 'termination' WHEN '4-NOT SPECIFIED' THEN 'insurance'
 ELSE CASE o_orderstatus WHEN 'F' THEN 'limitation_of_liability' WHEN 'O' THEN 'scope_of_work' ELSE 'security_clearance' END END"""
REVIEW_CATEGORY = """CASE o_orderpriority WHEN '1-URGENT' THEN 'indemnification' WHEN '2-HIGH' THEN 'payment_terms'
 WHEN '3-MEDIUM' THEN 'termination' WHEN '4-NOT SPECIFIED' THEN 'insurance'
 ELSE CASE o_orderstatus WHEN 'F' THEN 'liability' WHEN 'O' THEN 'scope_of_work' ELSE 'other' END END"""
K = "CAST(floor(o_totalprice / 10000) AS BIGINT)"
CLAUSE_ID = "concat('CLZ-', lpad(CAST(o_orderkey AS STRING), 12, '0'))"
CORPUS = f"""CASE o_orderpriority
 WHEN '1-URGENT' THEN CASE o_orderstatus WHEN 'F' THEN 'The Designer shall indemnify the Owner regardless of the Owner''s negligence.'
    WHEN 'O' THEN 'The Designer shall indemnify and defend the Owner to the fullest extent permitted by law.'
    ELSE 'The Designer shall indemnify the Owner for its own errors.' END
 WHEN '2-HIGH' THEN concat('Payment is due in (', CAST({K} AS STRING), ') days.', CASE o_orderstatus WHEN 'F' THEN '' ELSE ' Late payment bears interest.' END)
 WHEN '3-MEDIUM' THEN concat('The Owner may terminate for convenience upon (', CAST({K} AS STRING), ') days notice at its sole discretion.')
 WHEN '4-NOT SPECIFIED' THEN concat('Professional liability insurance of $', CAST({K} AS STRING), ',000,000 per claim is required.')
 ELSE CASE o_orderstatus WHEN 'F' THEN concat('Liability shall not exceed (', CAST({K} AS STRING), 'x) the total fees.')
    WHEN 'O' THEN concat('Design services as listed', CASE WHEN {K} > 25 THEN ', including but not limited to drawings.' ELSE '.' END)
    ELSE 'Everyone holds a valid clearance.' END END"""

_REFS = {
    "indemnification.must_be_limited_to_own_negligence": ("high", "o_orderpriority = '1-URGENT' AND o_orderstatus = 'F'"),
    "indemnification.duty_to_defend_permitted": ("high", "o_orderpriority = '1-URGENT' AND o_orderstatus = 'O'"),
    "indemnification.fullest_extent_permitted_by_law_permitted": ("medium", "o_orderpriority = '1-URGENT' AND o_orderstatus = 'O'"),
    "payment_terms.max_days_to_pay": ("medium", f"o_orderpriority = '2-HIGH' AND {K} > 30"),
    "payment_terms.late_interest_required": ("low", "o_orderpriority = '2-HIGH' AND o_orderstatus = 'F'"),
    "termination.min_notice_days_for_convenience": ("medium", f"o_orderpriority = '3-MEDIUM' AND {K} < 30"),
    "insurance.max_professional_liability_per_claim_usd": ("medium", f"o_orderpriority = '4-NOT SPECIFIED' AND {K} > 5"),
    "liability.max_cap_multiple_of_fees": ("high", f"o_orderpriority = '5-LOW' AND o_orderstatus = 'F' AND {K} > 1"),
    "scope_of_work.open_ended_scope_language_permitted": ("medium", f"o_orderpriority = '5-LOW' AND o_orderstatus = 'O' AND {K} > 25"),
}
RANK = {"low": 1, "medium": 2, "high": 3}
# DuckDB: the corpus with its expected findings.
FINDINGS_CTE = f"""c AS (SELECT *, {CLAUSE_ID} AS clause_id, {REVIEW_CATEGORY} AS review_category, {SOURCE_CATEGORY} AS source_category,
  list_filter([{', '.join(f"CASE WHEN {cond} THEN '{ref}' END" for ref, (_s, cond) in _REFS.items())}], lambda z: z IS NOT NULL) AS refs,
  greatest(0, {', '.join(f"CASE WHEN {cond} THEN {RANK[sev]} ELSE 0 END" for _r, (sev, cond) in _REFS.items())}) AS top,
  o_orderpriority = '3-MEDIUM' AS discretion,
  o_orderpriority = '1-URGENT' AND o_orderstatus = 'F' AS fault FROM orders)"""
SEVERITY_NAME = "['none', 'low', 'medium', 'high']"
SEVERITY_OF = "CASE " + " ".join(f"WHEN ref = '{r}' THEN '{s}'" for r, (s, _c) in _REFS.items()) + " END"
