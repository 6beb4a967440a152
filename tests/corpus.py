"""A small hand-written corpus: two exports of clause records with known breaches."""

from __future__ import annotations

import hashlib
import json


def _clause(n, contract, category, text, section, modified, status="active"):
    return {
        "clause_id": f"CLZ-2025-{n:04d}",
        "contract_id": f"CTR-{contract}",
        "client_name": f"Client {contract}",
        "project_name": f"Project {contract}",
        "_category": category,
        "clause_text": text,
        "section_ref": section,
        "effective_date": "2025-01-01",
        "expiration_date": "2027-12-31",
        "status": status,
        "last_modified": modified,
    }


FIRST = [
    _clause(1, 10, "indemnification",
            "The Designer shall indemnify, defend and hold harmless the Owner against every claim, regardless of whether it is caused in part by the Owner's negligence.",
            "Section 8.1", "2025-03-01T09:00:00Z"),
    _clause(2, 10, "limitation_of_liability",
            "All liability of the Designer shall not exceed the total fees paid under this contract.",
            "Section 8.3", "2025-03-01T09:00:00Z"),
    _clause(3, 10, "insurance",
            "The Designer carries professional liability insurance of at least $5,000,000 per claim and keeps it for five years following completion.",
            "Section 9.2", "2025-03-02T09:00:00Z"),
    _clause(4, 20, "payment_terms",
            "Invoices are paid within sixty (60) days. The Owner may withhold payment until any dispute about quality is settled.",
            "Section 5.1", "2025-02-01T09:00:00Z", "draft"),
    _clause(5, 20, "termination",
            "The Owner may end this contract for convenience upon fourteen (14) days notice, with no additional compensation for lost fees.",
            "Section 12.2", "2025-02-01T09:00:00Z"),
    _clause(6, 20, "scope_of_work",
            "The Designer provides all design services including but not limited to drawings and site visits.",
            "Section 2.1", "2025-02-01T09:00:00Z"),
    _clause(7, 30, "indemnification",
            "The Designer shall indemnify the Owner for its own errors. This shall not extend to the Owner's sole negligence.",
            "Section 7.1", "2025-04-01T09:00:00Z"),
    _clause(8, 30, "insurance",
            "The Designer maintains professional liability insurance of $10,000,000 per claim.",
            "Section 9.1", "2025-04-01T09:00:00Z"),
    _clause(9, 30, "consequential_damages",
            "Neither party answers for consequential or punitive damages, regardless of the legal theory.",
            "Section 8.4", "2025-04-01T09:00:00Z"),
    _clause(10, 40, "indemnification",
            "The Designer shall defend and indemnify the Owner to the fullest extent permitted by law.",
            "Section 10.1", "2025-05-01T09:00:00Z"),
    _clause(11, 40, "payment_terms",
            "Invoices are paid within thirty (30) days. Late amounts bear interest at the statutory rate.",
            "Section 4.2", "2025-05-01T09:00:00Z", "draft"),
    _clause(12, 40, "security_clearance",
            "Everyone on site holds a valid clearance before entering the restricted area.",
            "Section 14.1", "2025-05-01T09:00:00Z"),
]
SECOND = [
    _clause(13, 10, "indemnification",
            "The Designer has no obligation to indemnify the Owner for the Owner's negligence; its duty is limited to its own errors.",
            "Section 8.1 (Amended)", "2025-09-01T09:00:00Z"),
    _clause(14, 50, "payment_terms",
            "Invoices are paid within forty-five (45) days. The Owner keeps up to 10% of each invoice as retainage.",
            "Section 5.3", "2025-09-02T09:00:00Z", "under_review"),
    _clause(15, 50, "termination",
            "Either party may end this contract for cause upon thirty (30) days notice. The Owner may end it for convenience upon twenty-one (21) days notice and pays reasonable demobilization costs.",
            "Section 11.1", "2025-09-02T09:00:00Z"),
    _clause(16, 50, "insurance",
            "The Designer maintains professional liability insurance of $2,000,000 per claim.",
            "Section 9.1", "2025-09-02T09:00:00Z"),
    _clause(17, 30, "scope_of_work",
            "The Designer provides the mechanical design services listed in Exhibit A.",
            "Section 2.1 (Amended)", "2025-09-03T09:00:00Z"),
    _clause(18, 30, "limitation_of_liability",
            "The liability of the Designer shall not exceed two times (2x) the total fees paid.",
            "Section 8.2", "2025-09-03T09:00:00Z"),
    _clause(19, 60, "indemnification",
            "Each party shall indemnify the other for its own errors. Neither party shall be required to indemnify the other beyond that. The duty to defend runs alongside.",
            "Section 7.1", "2025-09-04T09:00:00Z"),
    _clause(20, 60, "payment_terms",
            "The Owner pays within thirty (30) days. Overdue amounts bear interest of 1.5% per month.",
            "Section 4.1", "2025-09-04T09:00:00Z"),
]
REVIEWS = {
    13: [("J. Doe", "2025-08-20", "flagged", "First wording was too broad"), ("K. Roe", "2025-08-28", "approved", "Fine now")],
    14: [("M. Poe", "2025-08-30", "flagged", "Retainage is unusual — look again")],
    17: [("R. Loe", "2025-08-22", "expanded", "More equipment added")],
    18: [("J. Doe", "2025-08-29", "flagged", "2x is above our standard")],
    19: [("K. Roe", "2025-09-01", "approved", "Mutual wording")],
}
DEFEND = "indemnification.duty_to_defend_permitted"
EXPECTED = {
    1: ["indemnification.must_be_limited_to_own_negligence", DEFEND],
    3: ["insurance.max_tail_years_after_completion"],
    4: ["payment_terms.max_days_to_pay", "payment_terms.discretionary_withholding_permitted",
        "payment_terms.late_interest_required"],
    5: ["termination.min_notice_days_for_convenience", "termination.demobilisation_costs_recoverable"],
    6: ["scope_of_work.open_ended_scope_language_permitted"],
    8: ["insurance.max_professional_liability_per_claim_usd"],
    10: [DEFEND, "indemnification.fullest_extent_permitted_by_law_permitted"],
    14: ["payment_terms.max_days_to_pay", "payment_terms.max_retainage_percent",
         "payment_terms.late_interest_required"],
    15: ["termination.min_notice_days_for_convenience"],
    18: ["liability.max_cap_multiple_of_fees"],
    19: [DEFEND],
}
CATEGORY = {
    "limitation_of_liability": "liability",
    "consequential_damages": "liability",
    "security_clearance": "other",
}
ALIASES = {"clause_type": "clause_category", "category": "clause_category"}


def first_document() -> str:
    clauses = []
    for c in FIRST:
        row = {("clause_type" if k == "_category" else k): v for k, v in c.items()}
        row["modified_by"] = "import"
        clauses.append(row)
    return json.dumps({"metadata": {"source": "contracts_api", "api_version": "2.1", "page": 1}, "clauses": clauses}, indent=1)


def second_document() -> str:
    clauses = []
    for c in SECOND:
        n = int(c["clause_id"][-4:])
        row = {("category" if k == "_category" else k): v for k, v in c.items()}
        reviews = [dict(zip(("reviewer", "date", "action", "notes"), r)) for r in REVIEWS.get(n, [])]
        row["review_history"] = {
            "reviews": reviews,
            "review_count": len(reviews),
            "last_review_date": reviews[-1]["date"] if reviews else None,
        }
        clauses.append(row)
    return json.dumps(
        {"metadata": {"source": "contracts_api", "api_version": "2.3", "page": 1}, "clauses": clauses},
        indent=1, ensure_ascii=False,
    )


def write_documents(folder) -> tuple[str, str]:
    folder.mkdir(parents=True, exist_ok=True)
    paths = []
    for name, text in (("batch_1.json", first_document()), ("batch_2.json", second_document())):
        (folder / name).write_bytes(text.encode("utf-8"))
        paths.append(str(folder / name))
    return paths[0], paths[1]


def sha(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8")).hexdigest()


SIMULATED = [
    (f"CLZ-2025-{1:04d}", "K. Roe", "2025-09-10", "confirmed", "risk.overall_severity", "high", "Agreed.", None, 0),
    (f"CLZ-2025-{10:04d}", "K. Roe", "2025-09-11", "override", f"risk.findings.{DEFEND}", "accepted",
     "Priced into the fee.", None, 1),
    (f"CLZ-2025-{4:04d}", "M. Poe", "2025-09-12", "confirmed", "risk.overall_severity", "high", "Yes.", None, 2),
    ("CLZ-2025-9999", "M. Poe", "2025-09-12", "override", None, None, "No such record.", None, 3),
]
SIMULATED_DDL = (
    "clause_id string, reviewer string, date string, action string, field string, human_value string, "
    "rationale string, note string, position bigint"
)


def labels():
    out = []
    for c in FIRST + SECOND:
        n = int(c["clause_id"][-4:])
        standards = EXPECTED.get(n, [])
        out.append((c["clause_id"], CATEGORY.get(c["_category"], c["_category"]), bool(standards), standards, "note"))
    return out


def given_outputs(silver):
    """Model texts as they would come from outside: here the keyword and wording evidence, written out."""
    from pyspark.sql import functions as F

    from attestra.operators import classify, residue

    text = F.lower(F.coalesce("clause_text", F.lit("")))
    return silver.select(
        "clause_id",
        F.to_json(classify.by_keywords(text)).alias("classification"),
        F.to_json(residue.narrative_assessment(text)).alias("assessment"),
    )
