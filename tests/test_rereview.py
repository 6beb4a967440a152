"""Decisions that hold, decisions that must be made again, and what that reads."""

import pytest
from pyspark.sql import functions as F

from attestra import schemas
from attestra.operators import ledger, rereview, rules
from attestra.operators.policy import BASELINE, Policy
from attestra.plans import ingest, normalise, review
from attestra.plans.lake import Lake
from tests import corpus

STRICT = Policy("9.0.0", BASELINE.with_value("payment_terms.max_days_to_pay", 1).standards)


def test_changed_standards_name_their_categories():
    assert BASELINE.changed(STRICT) == {"payment_terms.max_days_to_pay"}
    assert rules.affected_categories(BASELINE.changed(STRICT)) == {"payment_terms"}
    assert BASELINE.changed(BASELINE) == set() and rules.affected_categories(set()) == set()
    gone = BASELINE.without("liability.max_cap_multiple_of_fees")
    assert rereview.touched_since(gone, {"1": BASELINE}) == {"1": {"liability"}}


def test_idempotency_keys_tell_work_apart(spark):
    key = lambda *p: ledger.idempotency_key(*[F.lit(x).cast("string") for x in p])
    base = ("c", "h", "assess_risk", "p1", "1.0")
    other = [base, ("c", "h2", *base[2:]), ("c", "h", "assess_risk", "p2", "1.0"), ("c", "h", "assess_risk", "p1", "2.0"), ("ch", "", *base[2:]), ("c", "h", "assess_risk", None, "1.0")]
    keys = spark.range(1).select(*[key(*o).alias(str(k)) for k, o in enumerate([*other, base])]).first()
    assert len(set(keys)) == len(other) and keys[0] == keys[len(other)]


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("rereview")
    first, second = corpus.write_documents(root / "in")
    lake = Lake(str(root / "tables"))
    ingest.ingest(spark, lake, first, "2026-01-05T10:00:00.000Z")
    normalise.normalise(spark, lake, corpus.ALIASES)
    review.review(spark, lake, review.Settings("r1", "2026-01-06T00:00:00.000Z"))
    ingest.ingest(spark, lake, second, "2026-01-07T10:00:00.000Z")
    normalise.normalise(spark, lake, corpus.ALIASES)
    review.review(spark, lake, review.Settings("r2", "2026-01-08T00:00:00.000Z"))
    return lake


def _assessments(spark, lake, run):
    return spark.read.parquet(lake.path(f"assessments/run={run}"))


def test_the_second_run_reads_the_new_records_only(spark, lake):
    second = _assessments(spark, lake, "r2")
    assert {r.landed_on for r in second.select("landed_on").distinct().collect()} == {"2026-01-07"}
    assert _assessments(spark, lake, "r1").count() + second.count() == 20
    open_keys = review.record_keys(lake.silver(spark)).where("landed_on = '2026-01-07' AND review_group = 'liability'")
    plan = review.in_places(lake.silver(spark), open_keys)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "2026-01-07" in plan.split("PartitionFilters")[1]


def test_precedents_are_those_of_one_run_over_everything(spark, lake, tmp_path):
    whole = Lake(str(tmp_path / "whole"))
    for table in ("silver",):
        lake.silver(spark).write.partitionBy("review_group", "landed_on").parquet(whole.path(table))
    gold = review.review(spark, whole, review.Settings("all", "2026-01-08T00:00:00.000Z"))
    both = spark.read.parquet(lake.path("gold"))
    told = lambda g: {r.clause_id: (r.overall_severity, r.status, sorted(f.standard_reference for f in r.findings)) for r in g.collect()}
    assert told(gold) == told(both)
    late = {r.clause_id for r in lake.silver(spark).where("landed_on = '2026-01-07'").collect()}
    cited = lambda g: {r.clause_id: [list(f.precedent_clause_ids) for f in r.findings] for r in g.collect() if r.clause_id in late}
    assert cited(gold) == cited(both)


def test_delivery_twice_gives_no_row_and_a_new_policy_only_what_it_touches(spark, lake):
    rows = lake.read(spark, "ledger", schemas.LEDGER)
    before, keys = rows.count(), rows.where("decided_by <> 'human'").select("idempotency_key")
    assert keys.distinct().count() == keys.count()
    review.review(spark, lake, review.Settings("r3", "2026-01-09T00:00:00.000Z"))
    assert lake.read(spark, "ledger", schemas.LEDGER).count() == before
    asked = review.Settings("what_if", "2026-01-10T00:00:00.000Z", policy=STRICT)
    foreseen = review.rereview_changes(spark, lake, asked)
    found = foreseen.collect()
    touched = {r.clause_id for r in lake.silver(spark).where("review_group = 'payment_terms'").collect()}
    assert found and {r.clause_id for r in found} <= touched
    assert {r.standard_reference for r in found if r.change != "same"} == {"payment_terms.max_days_to_pay"}
    assert review.rereview_changes(spark, lake, asked, first_day="2026-01-07").count() < len(found)
    assert lake.read(spark, "ledger", schemas.LEDGER).count() == before  # nothing was written
    review.review(spark, lake, review.Settings("r4", "2026-01-10T00:00:00.000Z", policy=STRICT))
    again = _assessments(spark, lake, "r4")
    assert {r.clause_id for r in again.collect()} == touched
    mine = lake.read(spark, "ledger", schemas.LEDGER).where("run_id = 'r4' AND decided_by <> 'human'")
    assert {r.firm_standards_version for r in mine.collect()} == {"9.0.0"} and {r.clause_id for r in mine.collect()} <= touched
    written = lake.read(spark, "finding_changes", f"{schemas.FINDING_CHANGES}, run_id string").where("run_id = 'r4' AND change <> 'same'")
    told = lambda rs: sorted((r.clause_id, r.standard_reference, r.change, r.observed_after) for r in rs)
    assert told(written.collect()) == told([r for r in found if r.change != "same"])


def test_finding_changes(spark):
    finding = lambda ref, sev, seen="x": ("r", sev, 1.0, ref, seen, "e", None, [])
    ddl = f"clause_id string, record_hash string, findings array<{schemas.FINDING}>"
    before = spark.createDataFrame([("a", "1", [finding("s.x", "high"), finding("s.y", "low"), finding("s.x", "low")]), ("b", "1", [finding("s.x", "high")]), ("d", "1", [])], ddl)
    after = spark.createDataFrame([("a", "1", [finding("s.x", "high"), finding("s.z", "low"), finding("s.x", "medium")]), ("c", "1", [finding("s.x", "low")]), ("d", "1", [finding("s.x", "low")])], ddl)
    got = sorted((r.clause_id, r.standard_reference, r.change, r.severity_before or "", r.severity_after or "") for r in rereview.finding_changes(before, after).collect())
    assert got == [("a", "s.x", "changed", "low", "medium"), ("a", "s.x", "same", "high", "high"), ("a", "s.y", "removed", "low", ""), ("a", "s.z", "added", "", "low"), ("d", "s.x", "added", "", "low")]
