"""Scoring against labelled ground truth."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def scored(predictions: DataFrame, labels: DataFrame, key: str = "clause_id") -> DataFrame:
    """Predictions of labelled records only; adds ``correct``.

    ``predictions``: ``predicted, confidence, decided_by``; ``labels``: ``expected``.
    """
    return predictions.join(labels, key).withColumn(
        "correct", F.coalesce(F.col("predicted") == F.col("expected"), F.lit(False))
    )


def confusion(rows: DataFrame) -> DataFrame:
    """Off-diagonal counts; a missing prediction reads ``none``."""
    return (
        rows.where(~F.col("correct"))
        .groupBy("expected", F.coalesce("predicted", F.lit("none")).alias("predicted"))
        .agg(F.count(F.lit(1)).alias("records"))
    )


def accuracy(rows: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return rows.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if("correct").alias("correct"),
        F.round(F.coalesce(F.avg(F.when(F.col("correct"), 1.0).otherwise(0.0)), F.lit(0.0)), 4).alias("accuracy"),
    )


def calibration(rows: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Mean confidence when right and when wrong; a missing or zero confidence is left out."""
    given = F.when(F.col("confidence") != 0, F.col("confidence"))
    return rows.groupBy(*by).agg(
        F.round(F.avg(F.when(F.col("correct"), given)), 4).alias("mean_confidence_when_correct"),
        F.round(F.avg(F.when(~F.col("correct"), given)), 4).alias("mean_confidence_when_wrong"),
    )


def _ratio(top: Column, bottom: Column) -> Column:
    return F.when(bottom > 0, top / bottom).otherwise(F.lit(0.0))


def precision_recall(counts: DataFrame) -> DataFrame:
    """Add precision, recall and F1 to ``true_positives, false_positives, false_negatives``."""
    tp, fp, fn = (F.col(c) for c in ("true_positives", "false_positives", "false_negatives"))
    precision, recall = _ratio(tp, tp + fp), _ratio(tp, tp + fn)
    f1 = F.when(
        (precision + recall) > 0, F.lit(2.0) * precision * recall / (precision + recall)
    ).otherwise(F.lit(0.0))
    return counts.select(
        "*",
        F.round(precision, 4).alias("precision"),
        F.round(recall, 4).alias("recall"),
        F.round(f1, 4).alias("f1"),
    )


def flag_scores(rows: DataFrame, flagged: str = "flagged", should_flag: str = "should_flag") -> DataFrame:
    """Was the record flagged when it should be?"""
    f, s = F.col(flagged), F.col(should_flag)
    return precision_recall(
        rows.agg(
            F.count_if(f & s).alias("true_positives"),
            F.count_if(f & ~s).alias("false_positives"),
            F.count_if(~f & s).alias("false_negatives"),
        )
    )


def standard_scores(rows: DataFrame, found: str = "found", expected: str = "expected_standards") -> DataFrame:
    """Was it flagged for the right reasons?  Set sizes per row, one sum over all rows."""
    total = lambda c: F.coalesce(F.sum(F.size(c)), F.lit(0)).cast("bigint")
    return precision_recall(
        rows.agg(
            total(F.array_intersect(found, expected)).alias("true_positives"),
            total(F.array_except(found, expected)).alias("false_positives"),
            total(F.array_except(expected, found)).alias("false_negatives"),
        )
    )


def found_standards(findings: Column) -> Column:
    refs = F.transform(findings, lambda f: f["standard_reference"])
    return F.array_sort(F.array_distinct(F.filter(refs, lambda r: F.coalesce(r, F.lit("")) != "")))


def disagreements(rows: DataFrame, key: str = "clause_id", found: str = "found", expected: str = "expected_standards") -> DataFrame:
    """Records whose found and expected standards differ: what was missed, what was spurious."""
    missed = F.array_sort(F.array_except(expected, found))
    spurious = F.array_sort(F.array_except(found, expected))
    return rows.select(
        key,
        F.array_sort(F.array_distinct(expected)).alias("expected_standards"),
        F.array_sort(F.array_distinct(found)).alias("found_standards"),
        missed.alias("missed"),
        spurious.alias("spurious"),
    ).where((F.size("missed") > 0) | (F.size("spurious") > 0))
