"""Streaming landing, halts and resume, sources."""

import json

import pytest
from pyspark.sql import functions as F

from attestra import schemas
from attestra.operators.policy import BASELINE, Policy
from attestra.plans import ingest, normalise, review
from attestra.plans.lake import Lake
from attestra.sources import sinks, tables
from attestra.streaming import landing as streaming
from tests import corpus


def clock(batch):
    return f"2026-02-{batch + 1:02d}T00:00:00.000Z"


def test_stream_lands_each_file_once(spark, tmp_path):
    folder, control = tmp_path / "in", tmp_path / "control"
    folder.mkdir()
    control.mkdir()
    lake = Lake(str(tmp_path / "tables"))
    (folder / "batch_1.json").write_bytes(corpus.first_document().encode())
    assert streaming.run_landing(spark, lake, str(folder), clock, str(control)) == "complete"
    count = lambda: spark.read.parquet(lake.path("bronze")).count()
    assert count() == 12

    (control / "a.json").write_text(json.dumps({"requested_at": "2026-02-01", "paused": True}))
    (folder / "batch_2.json").write_bytes(corpus.second_document().encode())
    assert streaming.run_landing(spark, lake, str(folder), clock, str(control)) == "paused"
    assert count() == 12

    (control / "b.json").write_text(json.dumps({"requested_at": "2026-02-02", "paused": False}))
    assert streaming.run_landing(spark, lake, str(folder), clock, str(control)) == "complete"
    assert count() == 20
    assert streaming.run_landing(spark, lake, str(folder), clock, str(control)) == "complete"
    assert count() == 20
    assert lake.runs(spark).count() == 2
    kinds = {r["kind"] for r in lake.read(spark, "drift_events", ingest.DRIFT_EVENTS).collect()}
    assert "SUSPECTED_RENAME" in kinds

    # A restart adds an attempt; only the newest attempt reaches Silver, and hashes are unique.
    ingest.ingest(spark, lake, str(folder / "batch_2.json"), "2026-03-01T00:00:00.000Z", restart=True)
    assert count() == 28
    assert normalise.completed_bronze(spark, lake).count() == 20
    assert normalise.normalise(spark, lake, corpus.ALIASES).count() == 20


def test_stream_dedupe(spark, tmp_path):
    folder = tmp_path / "records"
    folder.mkdir()
    for name in ("a", "b"):
        (folder / f"{name}.json").write_text('{"record_hash": "x"}\n{"record_hash": "%s"}\n' % name)
    stream = spark.readStream.schema("record_hash string").json(str(folder))
    query = (
        streaming.dedupe_stream(stream)
        .writeStream.format("memory")
        .queryName("deduped")
        .option("checkpointLocation", str(tmp_path / "cp"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    assert sorted(r[0] for r in spark.table("deduped").collect()) == ["a", "b", "x"]


@pytest.fixture(scope="module")
def silver_lake(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("halt")
    first, second = corpus.write_documents(root / "in")
    lake = Lake(str(root / "tables"))
    ingest.ingest(spark, lake, [first, second], "2026-01-05T10:00:00.000Z")
    normalise.normalise(spark, lake, corpus.ALIASES)
    return lake


def test_two_files_in_one_landing_still_report_drift(spark, silver_lake):
    events = silver_lake.read(spark, "drift_events", ingest.DRIFT_EVENTS)
    assert events.count() == 6
    assert {r["run_id"].split("__")[0] for r in events.collect()} == {"batch_2"}


def test_halt_accounts_for_everything_and_resume_needs_an_acknowledgement(spark, silver_lake):
    tight = review.Settings("run_a", "2026-01-07T10:00:00.000Z", max_tokens=400, use_cache=False)
    outputs = corpus.given_outputs(spark.read.schema(schemas.SILVER).parquet(silver_lake.path("silver")))
    gold = review.review(spark, silver_lake, tight, model_outputs=outputs)
    states = {r["status"]: r["count"] for r in gold.groupBy("status").count().collect()}
    assert sum(states.values()) == 20 and 0 < states["not_processed"] < 20
    seen = {r["clause_id"]: len(r["findings"]) for r in gold.where("status <> 'not_processed'").collect()}

    again = review.Settings("run_b", "2026-01-08T10:00:00.000Z", use_cache=False)
    with pytest.raises(RuntimeError, match="acknowledge"):
        review.review(spark, silver_lake, again, model_outputs=outputs)
    gold = review.review(spark, silver_lake, again, model_outputs=outputs, acknowledged="looked at it")
    rows = {r["clause_id"]: r for r in gold.collect()}
    assert len(rows) == 20 and all(r["status"] != "not_processed" for r in rows.values())
    # Findings from before the halt are still there, and what needs a person still says so.
    assert all(len(rows[c]["findings"]) == n for c, n in seen.items())
    assert sum(r["review_status"] == "pending" for r in rows.values()) == 4
    ledger = silver_lake.read(spark, "ledger", schemas.LEDGER)
    assert ledger.where("action = 'acknowledge_halt'").count() == 1
    assert ledger.where("action = 'classify_clause'").count() == 20
    escalations = spark.read.parquet(silver_lake.path("escalations"))
    assert [r["reason"] for r in escalations.collect()] == ["category_outside_review_taxonomy"]


def test_model_outputs_as_a_table(spark, silver_lake):
    silver = spark.read.schema(schemas.SILVER).parquet(silver_lake.path("silver"))
    good = json.dumps({"category": "liability", "confidence": 0.4, "reasoning": "r"})
    outputs = silver.select(
        "clause_id",
        F.when(F.col("clause_id") < "CLZ-2025-0010", F.lit(good)).otherwise("nonsense").alias("classification"),
        F.lit('{"findings": []}').alias("assessment"),
    )
    settings = review.Settings("m", "t", prefer_rules=False)
    rows = {r["clause_id"]: r for r in review.assess(silver, settings, model_outputs=outputs).collect()}
    assert rows["CLZ-2025-0001"]["class_reason"] == "low_confidence_classification"
    assert rows["CLZ-2025-0011"]["class_reason"] == "unparseable_model_output" and rows["CLZ-2025-0011"]["failed"]
    assert rows["CLZ-2025-0012"]["class_reason"] == "category_outside_review_taxonomy"
    assert rows["CLZ-2025-0007"]["clean"] and not rows["CLZ-2025-0010"]["clean"]


def test_cached_decisions_cost_nothing(spark, silver_lake):
    silver = spark.read.schema(schemas.SILVER).parquet(silver_lake.path("silver"))
    empty = spark.createDataFrame([], schemas.CACHE)
    settings = review.Settings("c", "t")
    outputs = corpus.given_outputs(silver)
    first = review.assess(silver, settings, empty, outputs)
    store = first.where("risk_key is not null").select(F.col("risk_key").alias("key"), F.col("risk_content").alias("value"))
    second = review.assess(silver, settings, store, outputs)
    assert first.agg(F.sum("tokens")).first()[0] > 0
    assert second.agg(F.sum("tokens")).first()[0] == 0
    same = lambda df: {r["clause_id"]: (r["overall_severity"], len(r["findings"])) for r in df.collect()}
    assert same(first) == same(second)
    assert {r["risk_decided_by"] for r in second.collect()} == {"rule", "cache"}


def test_evidence_is_no_model_call(spark, silver_lake):
    silver = spark.read.schema(schemas.SILVER).parquet(silver_lake.path("silver"))
    settings = review.Settings("e", "t")
    with_texts = review.assess(silver, settings, model_outputs=corpus.given_outputs(silver))
    rows = review.assess(silver, settings, spark.createDataFrame([], schemas.CACHE))
    view = lambda df: {r["clause_id"]: (r["overall_severity"], len(r["findings"])) for r in df.collect()}
    assert view(rows) == view(with_texts)
    found = rows.collect()
    assert {r["risk_decided_by"] for r in found} == {"rule", "evidence"}
    assert all(r["tokens"] == 0 and r["risk_key"] is None and r["class_key"] is None for r in found)
    booked = review.decision_rows(rows.withColumn("processed_before", F.lit(0).cast("bigint")), settings)
    assert booked.where("model_name is not null or prompt_version is not null or usage.total_tokens > 0").count() == 0


def test_sources(spark, tmp_path, silver_lake):
    policy = {"version": "2.0.0", "standards": {"payment_terms": {"max_days_to_pay": {"value": 45, "severity_if_breached": "low"}}}}
    (tmp_path / "policy.json").write_text(json.dumps(policy))
    loaded = Policy.from_rows(tables.load_policy(spark, str(tmp_path / "policy.json")))
    assert loaded.version == "2.0.0" and loaded.value("payment_terms.max_days_to_pay") == 45
    (tmp_path / "aliases.json").write_text(json.dumps({"aliases": {
        "a": {"target": "t", "confirmed_by": "me"}, "b": {"target": "t", "confirmed_by": None}}}))
    assert [r["source_field"] for r in tables.load_aliases(spark, str(tmp_path / "aliases.json")).collect()] == ["a"]
    (tmp_path / "labels.json").write_text(json.dumps({"labels": {"c": {
        "expected_category": "x", "should_flag": True, "expected_standards": ["s"], "notes": "n"}}}))
    assert tables.load_labels(spark, str(tmp_path / "labels.json")).first()["expected_standards"] == ["s"]
    (tmp_path / "reviews.json").write_text(json.dumps({"reviews": [{"clause_id": "c", "action": "override"}]}))
    assert tables.load_simulated_reviews(spark, str(tmp_path / "reviews.json")).first()["position"] == 0
    silver = tables.read_silver(spark, silver_lake.path("silver"))
    sinks.export_sorted(silver, str(tmp_path / "silver_json"), "clause_id")
    assert tables.read_silver(spark, str(tmp_path / "silver_json"), "json").count() == 20
    document = {"clauses": [json.loads(r[0]) for r in silver.select(F.to_json(F.struct("*"))).collect()]}
    (tmp_path / "silver.json").write_text(json.dumps(document))
    again = tables.read_silver(spark, str(tmp_path / "silver.json"), "document")
    assert sorted(again.collect()) == sorted(silver.collect())
    missing = str(tmp_path / "nothing")
    for read in (tables.read_ledger, tables.read_cache, tables.read_registry, tables.read_registry_inventory):
        assert read(spark, missing).count() == 0
    assert BASELINE.version == "1.0.0"


def test_unconfirmed_rename_is_visible_not_silent(spark, silver_lake):
    only_old = {"clause_type": "clause_category"}
    from attestra.operators import landing, silver

    rows = silver.to_silver(landing.dedupe_replays(normalise.completed_bronze(spark, silver_lake)), only_old)
    new = rows.where("_lineage.source_api_version = '2.3'").collect()
    assert len(new) == 8
    assert all(r["clause_category"] is None and r["_unmapped_fields"] == ["category"] for r in new)
