"""Rules that users add, and the reports of a run and of an evaluation."""

import re

import pandas as pd
import pytest
from pyspark.sql import functions as F

from attestra import fixed_values as fixed
from attestra import schemas
from attestra.functions import numbers
from attestra.operators import rules
from attestra.operators.policy import BASELINE, Policy
from attestra.plans import evaluate, ingest, normalise, review
from attestra.plans.lake import Lake
from tests import corpus

REFERENCE = "payment_terms.max_days_to_pay"
POLICY = Policy("7.0.0", BASELINE.standards)


def rows(spark):
    texts = [("payment_terms", "Pay within (45) days."), ("payment_terms", "Pay within forty-five days."), ("payment_terms", "Pay now."), ("termination", "(99) days"), (None, "(99) days")]
    return spark.createDataFrame([(str(k), *t) for k, t in enumerate(texts)], "clause_id string, review_category string, clause_text string")


def fired(found):
    return {r.clause_id: [(f.standard_reference, f.observed) for f in r.findings] for r in found.collect()}


def test_a_rule_in_sql_calls_registered_functions(spark):
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION days_in(t STRING) RETURNS INT RETURN try_cast(nullif(regexp_extract(t, 'within .(\\\\d+)', 1), '') AS INT)")
    rule = rules.sql_rule(REFERENCE, "days_in(text)", "value > bound", "concat('value ', CAST(value AS STRING))")
    found = fired(rules.with_findings(rows(spark), POLICY, rules={"payment_terms": [rule]}))
    assert [k for k, v in found.items() if v] == ["0"] and found["0"][0][0] == REFERENCE


def test_an_arrow_function_reads_what_the_columns_leave_open(spark):
    def in_words(texts: pd.Series) -> pd.Series:
        assert not texts.str.contains("99").any() and not texts.str.contains(r"\(").any()  # open rows of its category only
        return texts.map(lambda t: 45.0 if "forty-five" in t else None)

    def fires(_text, value, policy):
        return value > F.lit(float(policy.value(REFERENCE))), rules.finding(REFERENCE, policy, value.cast("int").cast("string"), F.lit("30"))

    rule = rules.Rule(REFERENCE, fires, lambda text: numbers.first_days(text).cast("double"), in_words)
    found = fired(rules.with_findings(rows(spark), POLICY, rules={"payment_terms": [rule]}))
    assert [k for k, v in sorted(found.items()) if v] == ["0", "1"]


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("registry")
    paths = corpus.write_documents(root / "in")
    lake = Lake(str(root / "tables"))
    ingest.ingest(spark, lake, list(paths), "2026-01-05T10:00:00.000Z")
    normalise.normalise(spark, lake, corpus.ALIASES)
    return lake


def test_a_run_accepts_added_rules_and_reports_itself(spark, lake):
    rule = rules.sql_rule(REFERENCE, "length(text)", "value > 10 AND value > bound")
    added = rules.extended_rules("payment_terms", rule)
    gold = review.review(spark, lake, review.Settings("r1", "2026-01-06T00:00:00.000Z", rules=added))
    payment = lake.silver(spark).where("review_group = 'payment_terms'").count()
    extra = gold.where(F.size(F.filter("findings", lambda f: f["standard_reference"] == REFERENCE)) > 0)
    assert extra.count() == payment
    row = spark.read.parquet(lake.path("run_summary")).first()
    assert (row.run_id, row.status, row.halt_reason, row.policy_version) == ("r1", "complete", None, BASELINE.version)
    assert (row.model_name, row.model_calls, row.total_tokens, row.cost_usd, row.cache_hit_rate) == (None, 0, 0, 0.0, 0.0)
    assert row.clauses_total == 20
    details = spark.read.parquet(lake.path("escalations"))
    assert details.count() > 0 and details.where("detail IS NULL").count() == 0


def test_the_evaluation_is_kept(spark, lake):
    labels = spark.createDataFrame(corpus.labels(), schemas.LABELS)
    head = evaluate.write_report(spark, lake, labels, "2026-01-09", labels_version="v1", prompt_version="p1").first()
    assert (head.records, head.policy_version, head.prompt_version, head.labels_version) == (20, BASELINE.version, "p1", "v1")
    assert head.accuracy_configured == 1.0 and head.standard_f1 == 1.0 and 0 < head.accuracy_model_only <= 1.0
    modes = {r.mode for r in spark.read.parquet(lake.path("eval_by_path")).collect()}
    assert modes == {"configured", "model_only"}
    evaluate.write_report(spark, lake, labels, "2026-01-10", model_only=True)
    assert spark.read.parquet(lake.path("eval_report")).count() == 2


def test_tail_years_and_amounts_are_searched_for_once(spark):
    texts = ["kept for 3 years following completion", "one - forty-five  years following\ncompletion", "x7 year following completion", "7x years following completion"]
    texts += [" years following completion, 12 years following completion", "eleven12 years following completion", "some years", "٣ years following completion", "", None]
    texts += ["up to 7.5% is retainage", "withhold 1.5%"]
    lowered = F.col("t")
    read = spark.createDataFrame([(t,) for t in texts], "t string").select(
        "t", numbers.tail_years(lowered).cast("int").alias("years"), numbers.amount(lowered, r"up to\s+(\d+(?:\.\d+)?)%[^.]*retainage").alias("percent")
    )
    plan = read._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract(") == 2  # each value repeated its search to see whether it was empty
    old = re.compile(r"([a-z\-]+|\d+)\s+years?\s+following\s+completion")
    for row in read.collect():
        found = old.search(row.t or "")
        token = found and found[1]
        assert row.years == (int(token) if token and token.isdigit() else fixed.NUMBER_WORDS.get(token))
        assert row.percent == (7.5 if row.t == "up to 7.5% is retainage" else None)
