"""Score classification and risk flags against labelled records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from attestra.operators import classify, evaluation, rules
from attestra.operators.policy import BASELINE, Policy
from attestra.plans.lake import Lake
from attestra.sources import sinks


def classification_scores(silver: DataFrame, labels: DataFrame, model_only: bool = False) -> dict[str, DataFrame]:
    """Accuracy (overall and by decision path), calibration and confusion."""
    predicted = classify.classify(silver, prefer_rules=not model_only).select(
        "clause_id",
        F.col("classification.category").alias("predicted"),
        F.col("classification.confidence").alias("confidence"),
        F.col("class_decided_by").alias("decided_by"),
    )
    rows = evaluation.scored(
        predicted, labels.select("clause_id", F.col("expected_category").alias("expected"))
    )
    return {
        "accuracy": evaluation.accuracy(rows),
        "by_path": evaluation.accuracy(rows, ["decided_by"]),
        "calibration": evaluation.calibration(rows),
        "confusion": evaluation.confusion(rows),
    }


def write_report(
    spark: SparkSession, lake: Lake, labels: DataFrame, generated_at: str, policy: Policy = BASELINE, model_name: str = "evidence",
    prompt_version: str | None = None, labels_version: str = "unversioned", model_only: bool = False,
) -> DataFrame:
    """Score both ways of classifying (``model_only``: that one alone) and the risk flags, and keep it all.

    Tables ``eval_<name>``, one folder a report: ``report`` is its head, the others are long tables with a ``mode``
    where both ways have one.  Returns the head.
    """
    silver = lake.silver(spark)
    modes = ["model_only"] if model_only else ["configured", "model_only"]
    tables: dict[str, DataFrame] = dict(risk_scores(silver, labels, policy))
    for mode in modes:
        for name, scores in classification_scores(silver, labels, mode == "model_only").items():
            scores = scores.select(F.lit(mode).alias("mode"), "*")
            tables[name] = tables[name].unionByName(scores) if name in tables else scores
    for name, rows in tables.items():
        sinks.replace_partition(rows.withColumn("generated_at", F.lit(generated_at)), lake.path(f"eval_{name}"), "generated_at")
    accuracy = spark.read.parquet(lake.path("eval_accuracy")).where(F.col("generated_at") == generated_at)
    told = {
        "generated_at": generated_at, "labels_version": labels_version, "model_name": model_name, "prompt_version": prompt_version,
        "policy_version": policy.version,
    }
    head = labels.agg(F.count(F.lit(1)).alias("records")).withColumns({n: F.lit(v).cast("string") for n, v in told.items()})
    best = accuracy.agg(*[F.max(F.when(F.col("mode") == m, F.col("accuracy"))).alias(f"accuracy_{m}") for m in ("configured", "model_only")])
    flags = tables["standard_level"].select(F.col("f1").alias("standard_f1"))
    one = lambda df: df.withColumn("_one", F.lit(1))
    report = one(head).join(one(best), "_one").join(one(flags), "_one").drop("_one")
    sinks.replace_partition(report, lake.path("eval_report"), "generated_at")
    return spark.read.parquet(lake.path("eval_report")).where(F.col("generated_at") == generated_at)


def risk_scores(silver: DataFrame, labels: DataFrame, policy: Policy = BASELINE) -> dict[str, DataFrame]:
    """Precision and recall of flags and of the standards behind them.

    The rules run on the labelled category, so that classification errors do not count here.
    """
    labelled = silver.join(labels, "clause_id")
    found = rules.with_findings(labelled, policy, category="expected_category").withColumn(
        "found", evaluation.found_standards(F.col("findings"))
    ).withColumn("flagged", F.size("found") > 0)
    return {
        "clause_level": evaluation.flag_scores(found),
        "standard_level": evaluation.standard_scores(found),
        "disagreements": evaluation.disagreements(found),
    }
