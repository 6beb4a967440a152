"""The whole way from documents to the register, on the hand-written corpus."""

import json

import pytest
from pyspark.sql import functions as F

from attestra import schemas
from attestra.operators import contract, drift
from attestra.operators.policy import BASELINE
from attestra.plans import approve, evaluate, ingest, normalise, review
from attestra.plans.lake import Lake
from attestra.session import cut_lineage
from attestra.sources.documents import read_documents
from tests import corpus

FIRST_TIME, SECOND_TIME = "2026-01-05T10:00:00.000Z", "2026-01-06T10:00:00.000Z"


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("lake")
    first, second = corpus.write_documents(root / "in")
    lake = Lake(str(root / "tables"))
    ingest.ingest(spark, lake, first, FIRST_TIME)
    ingest.ingest(spark, lake, second, SECOND_TIME)
    normalise.normalise(spark, lake, corpus.ALIASES)
    normalise.propose_supersessions(spark, lake)
    return lake


@pytest.fixture(scope="module")
def reviewed(spark, lake):
    simulated = spark.createDataFrame(corpus.SIMULATED, corpus.SIMULATED_DDL)
    settings = review.Settings("review_1", "2026-01-07T10:00:00.000Z")
    outputs = corpus.given_outputs(spark.read.schema(schemas.SILVER).parquet(lake.path("silver")))
    review.review(spark, lake, settings, simulated, outputs)
    return lake


def _bronze(spark, lake):
    return lake.read(spark, "bronze", ingest.BRONZE_TABLE)


def test_run_ids_come_from_content(spark, lake):
    runs = {r["source_file"]: r for r in lake.runs(spark).collect()}
    for name, text in (("batch_1.json", corpus.first_document()), ("batch_2.json", corpus.second_document())):
        digest = corpus.sha(text)
        assert runs[name]["source_sha256"] == digest
        assert runs[name]["run_id"] == f"{name[:-5]}__{digest[:8]}"
        assert runs[name]["records_written"] == runs[name]["records_in_source"] == runs[name]["unique_record_hashes"]


def test_record_hash_equals_canonical_json(spark, lake):
    got = {r["h"] for r in _bronze(spark, lake).select(F.col("_bronze.record_hash").alias("h")).collect()}
    want = set()
    for text in (corpus.first_document(), corpus.second_document()):
        for clause in json.loads(text)["clauses"]:
            canonical = json.dumps(clause, sort_keys=True, separators=(",", ":"), ensure_ascii=False)
            want.add("sha256:" + corpus.sha(canonical))
    assert got == want and len(got) == 20


def test_payload_is_kept_as_it_came(spark, lake):
    rows = _bronze(spark, lake).where(F.col("_bronze.source_file") == "batch_2.json").collect()
    originals = json.loads(corpus.second_document())["clauses"]
    for row in rows:
        assert list(json.loads(row["payload"]).items()) == list(originals[row["_bronze"]["record_index"]].items())


def test_source_bytes_are_kept(spark, lake):
    kept = {r["source_file"]: bytes(r["content"]) for r in spark.read.parquet(lake.path("source_snapshots")).collect()}
    assert kept == {"batch_1.json": corpus.first_document().encode(), "batch_2.json": corpus.second_document().encode()}


def test_landing_again_changes_nothing(spark, lake, tmp_path):
    before = _bronze(spark, lake).count()
    first, _ = corpus.write_documents(tmp_path / "again")
    ingest.ingest(spark, lake, first, "2026-01-09T10:00:00.000Z")
    assert _bronze(spark, lake).count() == before
    assert lake.runs(spark).count() == 2


def test_drift_between_the_two_versions(spark, lake):
    events = lake.read(spark, "drift_events", ingest.DRIFT_EVENTS)
    rows = [(r["kind"], r["severity"], r["path"]) for r in drift.in_report_order(events, ["run_id"]).collect()]
    assert rows == [
        ("API_VERSION_CHANGED", "INFO", "metadata.api_version"),
        ("FIELD_REMOVED", "BREAKING", "modified_by"),
        ("SUSPECTED_RENAME", "NEEDS_HUMAN_CONFIRMATION", "clause_type -> category"),
        ("FIELD_ADDED", "ADDITIVE", "review_history"),
        ("FIELD_REMOVED", "INFO", "clause_type"),
        ("ENUM_VALUE_ADDED", "INFO", "status"),
    ]
    added = events.where("kind = 'FIELD_ADDED'").first()
    assert len(json.loads(added["evidence"])["nested_paths"]) == 7
    rename = events.where("kind = 'SUSPECTED_RENAME'").first()
    assert rename["confidence"] == 0.75
    reports = {r["api_version"]: r for r in spark.read.parquet(lake.path("drift_reports")).collect()}
    assert reports["2.1"]["compared_against"] == "none (first batch from this source)"
    assert not reports["2.1"]["drift_detected"] and reports["2.3"]["compared_against"] == "2.1"
    assert reports["2.3"]["events"] == 6 and reports["2.3"]["requires_human_action"]


def test_inventory_sizes(spark, lake):
    paths = lake.snapshot(spark, "registry_inventory", schemas.REGISTRY_INVENTORY)
    counts = {r["api_version"]: r["count"] for r in paths.groupBy("api_version").count().collect()}
    assert counts == {"2.1": 12, "2.3": 19}
    registry = {r["api_version"]: r for r in lake.snapshot(spark, "registry", schemas.REGISTRY).collect()}
    assert not registry["2.1"]["is_latest"] and registry["2.3"]["is_latest"]
    assert registry["2.1"]["first_seen"] == FIRST_TIME


def test_silver_null_counts_and_contract(spark, lake):
    nulls = {r["field"]: r["null_count"] for r in spark.read.parquet(lake.path("null_counts")).collect()}
    assert nulls.pop("modified_by") == 8 and nulls.pop("review_history") == 12
    assert set(nulls.values()) == {0}
    silver = spark.read.schema(schemas.SILVER).parquet(lake.path("silver"))
    assert silver.count() == 20
    broken = contract.contract_violations(contract.as_contract_json(silver), contract.SILVER_JSON_SCHEMA, "clause_id")
    assert broken.collect() == []
    spoiled = silver.withColumn("clause_id", F.lit("X")).withColumn("client_name", F.lit(None).cast("string"))
    found = contract.contract_violations(
        contract.as_contract_json(spoiled), contract.SILVER_JSON_SCHEMA, "clause_id"
    ).groupBy("path", "rule").count().collect()
    assert {(r["path"], r["rule"], r["count"]) for r in found} == {
        ("$.clause_id", "pattern", 20), ("$.client_name", "type", 20)
    }


def test_supersession_and_orphan(spark, lake):
    rows = spark.read.parquet(lake.path("supersession_proposals")).collect()
    by_kind = {r["kind"]: r for r in rows}
    assert len(rows) == 2
    assert by_kind["SUPERSESSION_CANDIDATE"]["superseded_clause_id"] == "CLZ-2025-0001"
    assert by_kind["SUPERSESSION_CANDIDATE"]["superseding_clause_id"] == "CLZ-2025-0013"
    assert by_kind["SUPERSESSION_CANDIDATE"]["evidence"]["superseding_review_notes"] == [
        "First wording was too broad", "Fine now"
    ]
    assert by_kind["AMENDS_UNKNOWN_CLAUSE"]["clause_id"] == "CLZ-2025-0017"


def test_findings_per_record(spark, reviewed):
    gold = {int(r["clause_id"][-4:]): r for r in spark.read.parquet(reviewed.path("gold")).collect()}
    assert len(gold) == 20
    found = {n: [f["standard_reference"] for f in r["findings"]] for n, r in gold.items() if r["findings"]}
    assert found == corpus.EXPECTED
    assert gold[12]["status"] == "escalated" and gold[12]["review_category"] == "other"
    assert gold[1]["superseded_by"] == "CLZ-2025-0013"
    assert gold[1]["findings"][0]["precedent_clause_ids"] == ["CLZ-2025-0007", "CLZ-2025-0013"]
    assert gold[18]["findings"][0]["risk"] == "Liability cap of 2x fees exceeds the firm standard of 1x."
    assert gold[8]["findings"][0]["observed"] == "$10,000,000 per claim"
    assert gold[15]["findings"][0]["observed"] == "21 days' notice"


def test_severity_after_overrides(spark, reviewed):
    row = spark.read.parquet(reviewed.path("run_summary")).first()
    assert (row["severity_high"], row["severity_medium"], row["severity_low"], row["severity_none"]) == (3, 6, 2, 9)
    assert row["review_pending"] == 3 and row["clauses_not_processed"] == 0
    assert row["escalated"] == 1 and row["overridden"] == 2


def test_ledger_and_learning(spark, reviewed):
    ledger = reviewed.read(spark, "ledger", schemas.LEDGER)
    by = {r["decided_by"]: r["count"] for r in ledger.groupBy("decided_by").count().collect()}
    # 20 classifications and 3 rules-only assessments, 17 second passes, 8 human rows.
    assert by == {"rule": 23, "model": 17, "human": 8}
    assert ledger.where("action = 'classify_clause'").count() == 20
    overrides = {r["override_id"] for r in spark.read.parquet(reviewed.path("overrides")).collect()}
    assert overrides == {"OVR-CLZ-2025-0019-01", "OVR-CLZ-2025-0010-02"}
    proposal = spark.read.parquet(reviewed.path("learning_proposals")).collect()
    assert [(p["proposal_id"], p["occurrences"], p["current_value"]) for p in proposal] == [
        ("LP-indemnification-duty_to_defend_permitted", 2, "false")
    ]
    evidence = spark.read.parquet(reviewed.path("learning_evidence")).orderBy("seq").collect()
    assert [e["clause_id"] for e in evidence] == ["CLZ-2025-0019", "CLZ-2025-0010"]


def test_totals_of_the_run(spark, reviewed):
    usage = spark.read.parquet(reviewed.path("usage_totals")).first()
    assert usage["calls"] == 17 and usage["total_tokens"] == usage["input_tokens"] + usage["output_tokens"] > 0
    decided = {r["decided_by"]: r["records"] for r in spark.read.parquet(reviewed.path("decision_counts")).collect()}
    assert decided == {"rule": 23, "model": 17, "human": 8}
    hits = spark.read.parquet(reviewed.path("cache_stats")).first()
    assert (hits["hits"], hits["misses"], hits["hit_rate"]) == (0, 17, 0.0)
    queue = {r["reason"]: r["records"] for r in spark.read.parquet(reviewed.path("escalation_counts")).collect()}
    assert queue == {"category_outside_review_taxonomy": 1}


def test_approved_proposal_becomes_a_new_policy_version(spark, reviewed):
    name = "LP-indemnification-duty_to_defend_permitted"
    with pytest.raises(ValueError, match="approver"):
        approve.approve(spark, reviewed, name, "", "because", "2026-01-09T00:00:00.000Z")
    assert approve.current_policy(spark, reviewed).version == "1.0.0"
    policy = approve.approve(spark, reviewed, name, "Ann Person", "because", "2026-01-09T00:00:00.000Z")
    assert policy.version == "1.1.0" == approve.current_policy(spark, reviewed).version
    assert spark.read.parquet(reviewed.path("policy_exceptions")).count() == 2
    assert spark.read.parquet(reviewed.path("approvals")).first()["approved_by"] == "Ann Person"
    ledger = reviewed.read(spark, "ledger", schemas.LEDGER)
    assert ledger.where("action = 'apply_learning_proposal'").count() == 1
    with pytest.raises(ValueError, match="pending"):
        approve.approve(spark, reviewed, name, "Ann Person", "again", "2026-01-10T00:00:00.000Z")


def test_second_run_skips_everything(spark, reviewed):
    before = reviewed.read(spark, "ledger", schemas.LEDGER).count()
    simulated = spark.createDataFrame(corpus.SIMULATED, corpus.SIMULATED_DDL)
    gold = review.review(spark, reviewed, review.Settings("review_2", "2026-01-08T10:00:00.000Z"), simulated)
    assert reviewed.read(spark, "ledger", schemas.LEDGER).count() == before
    assert gold.where("status = 'not_processed'").count() == 0
    assert gold.where("review_status = 'pending'").count() == 3


def test_evaluation_and_mutations(spark, lake):
    silver = cut_lineage(spark.read.schema(schemas.SILVER).parquet(lake.path("silver")))
    labels = spark.createDataFrame(corpus.labels(), schemas.LABELS)
    scores = evaluate.risk_scores(silver, labels)
    flags = scores["clause_level"].first()
    assert (flags["true_positives"], flags["false_positives"], flags["false_negatives"]) == (11, 0, 0)
    standards = scores["standard_level"].first()
    assert (standards["true_positives"], standards["f1"]) == (18, 1.0)
    assert scores["disagreements"].collect() == []
    weaker = evaluate.risk_scores(silver, labels, BASELINE.without("liability.max_cap_multiple_of_fees"))
    assert [r["clause_id"] for r in weaker["disagreements"].collect()] == ["CLZ-2025-0018"]
    tighter = evaluate.risk_scores(silver, labels, BASELINE.with_value("payment_terms.max_days_to_pay", 1))
    spurious = {r["clause_id"]: r["spurious"] for r in tighter["disagreements"].collect()}
    assert spurious["CLZ-2025-0020"] == ["payment_terms.max_days_to_pay"]
    classes = evaluate.classification_scores(silver, labels)
    assert classes["accuracy"].first()["accuracy"] == 1.0
    assert classes["calibration"].first()["mean_confidence_when_wrong"] is None


def test_a_document_without_a_list_is_a_reject(spark, tmp_path):
    (tmp_path / "bad.json").write_text('{"metadata": {}, "clauses": {"a": 1}}')
    rows = read_documents(spark, str(tmp_path / "bad.json")).collect()
    assert [(r.record_index, r.reason) for r in rows] == [(None, None), (None, "records_not_a_list")]
