"""Two records that share an id: reviews, overrides and model texts keep them apart."""

import json

import pytest
from pyspark.sql import functions as F

from attestra import schemas
from attestra.operators import ledger, reviews
from attestra.plans import review
from attestra.plans.lake import Lake

RISKY = "All liability of the Designer shall not exceed three times (3x) the total fees paid under this contract."
HEAVY = "The Designer shall indemnify, defend and hold harmless the Owner against every claim, regardless of whether it is caused in part by the Owner's negligence."
NO_REVIEW = {"reviews": [], "review_count": 0, "last_review_date": None}


def _record(clause_id, record_hash, category, text, *met):
    history = {"reviews": [dict(zip(("reviewer", "date", "action", "notes"), m, strict=True)) for m in met]}
    return {
        "clause_id": clause_id, "contract_id": "c", "clause_category": category, "clause_text": text, "status": "active",
        "review_history": {**NO_REVIEW, **history}, "_unmapped_fields": [], "_lineage": {"record_hash": record_hash},
    }


def _silver(spark, rows):
    texts = spark.createDataFrame([(json.dumps(r),) for r in rows], "r string")
    return texts.select(F.from_json("r", schemas.SILVER).alias("r")).select("r.*")


@pytest.fixture
def lake(spark, tmp_path):
    lake = Lake(str(tmp_path))
    met = ("ann", "2026-01-01", "approved", "fine")
    rows = [_record("K", "a", "indemnification", HEAVY, met), _record("K", "b", "indemnification", HEAVY + " Twice.")]
    _silver(spark, rows + [_record("L", "c", "indemnification", HEAVY)]).write.parquet(lake.path("silver"))
    return lake


def _states(gold):
    return {r["lineage"]["record_hash"]: (r["overall_severity"], r["status"]) for r in gold.collect()}


def test_a_review_in_one_record_leaves_its_namesake(spark, lake):
    states = _states(review.review(spark, lake, review.Settings("one", "2026-01-02T00:00:00.000Z")))
    assert states["a"] == ("low", "overridden")
    assert states["b"] == states["c"] == ("high", "proposed")
    found = lake.read(spark, "overrides", schemas.OVERRIDES).collect()
    assert [(r["clause_id"], r["record_hash"]) for r in found] == [("K", "a")]

    # A simulated review without a hash is about all records of the id, each once; a later run adds nothing.
    ddl = schemas.REVIEWS.replace("source string, ", "")
    simulated = spark.createDataFrame([("K", "bob", "2026-01-03", "override", None, "waived", "r", 0)], ddl)
    for run in ("two", "three"):
        states = _states(review.review(spark, lake, review.Settings(run, "2026-01-04T00:00:00.000Z"), simulated))
        assert states["a"] == states["b"] == ("low", "overridden") and states["c"] == ("high", "proposed")
        found = lake.read(spark, "overrides", schemas.OVERRIDES).collect()
        assert sorted((r["reviewer"], r["record_hash"]) for r in found) == [("ann", "a"), ("bob", "a"), ("bob", "b")]
        human = lake.read(spark, "ledger", schemas.LEDGER).where("action = 'human_override'")
        assert human.select(ledger.record_hash().alias("h")).groupBy("h").count().orderBy("h").collect() == [("a", 2), ("b", 1)]


def test_recorded_rows_without_a_hash_stand_for_the_id(spark, lake):
    silver = spark.read.schema(schemas.SILVER).parquet(lake.path("silver"))
    sides = spark.createDataFrame(
        [("K", "a", [], "high", "proposed"), ("K", "b", [], "medium", "proposed")],
        f"clause_id string, record_hash string, findings array<{schemas.FINDING}>, overall_severity string, risk_status string",
    )
    met = reviews.reconcile(reviews.human_reviews(silver), sides)
    first = reviews.overrides(met)
    assert [(r["record_hash"], r["model_value"]) for r in first.collect()] == [("a", "high")]
    old = first.withColumn("record_hash", F.lit(None).cast("string"))
    assert reviews.overrides(met, recorded=old).count() == 0
    rows = reviews.review_ledger_rows(met, first, "r", "t")
    assert ledger.not_yet_recorded(rows, rows.withColumn("lineage", F.lit(None).cast(schemas.LINEAGE))).count() == 0
    view = sides.withColumn("status", F.col("risk_status")).withColumn("review_status", F.lit("pending"))
    counts = lambda found: {r["record_hash"]: r["override_count"] for r in reviews.with_overrides(view, found).collect()}
    assert counts(first) == {"a": 1, "b": None}
    assert counts(old) == {"a": 1, "b": 1} and counts(first.unionByName(old)) == {"a": 2, "b": 1}


def test_model_texts_of_a_record(spark, lake):
    silver = spark.read.schema(schemas.SILVER).parquet(lake.path("silver"))
    said = lambda c: json.dumps({"category": c, "confidence": 0.9, "reasoning": "r"})
    given = [("K", "a", "insurance"), ("K", None, "liability"), ("K", None, "indemnification"), ("L", "c", "insurance"), ("L", "c", "payment")]
    rows = [(k, h, said(c), '{"findings": []}') for k, h, c in given]
    settings = review.Settings("m", "t", prefer_rules=False)
    for each in (rows, rows[::-1]):
        outputs = spark.createDataFrame(each, "clause_id string, record_hash string, classification string, assessment string").coalesce(1)
        told = {r["record_hash"]: json.loads(r["class_content"])["category"] for r in review.assess(silver, settings, model_outputs=outputs).collect()}
        assert told == {"a": "insurance", "b": "liability", "c": "payment"}
