"""A named person turns a pending proposal into the next policy version."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from attestra import schemas
from attestra.operators import learning
from attestra.operators.ledger import PARTITIONS
from attestra.operators.policy import BASELINE, Policy
from attestra.plans.lake import Lake
from attestra.session import cut_lineage
from attestra.sources import sinks


def current_policy(spark: SparkSession, lake: Lake) -> Policy:
    """The newest version in the policy table; the baseline while there is none."""
    rows = lake.snapshot(spark, "policy", schemas.POLICY)
    return BASELINE if rows.isEmpty() else Policy.from_rows(rows)


def approve(
    spark: SparkSession, lake: Lake, proposal_id: str, approved_by: str, rationale: str, timestamp: str
) -> Policy:
    """Apply one proposal; everything is appended, earlier versions and rows stay.

    The approvals are looked up first, so that a proposal cannot be applied twice.
    """
    policy = current_policy(spark, lake).to_rows(spark)
    proposals = spark.read.parquet(lake.path("learning_proposals"))
    evidence = spark.read.parquet(lake.path("learning_evidence"))
    done = lake.read(spark, "approvals", "proposal_id string").select("proposal_id").withColumn("_done", F.lit(True))
    proposals = proposals.join(done, "proposal_id", "left").withColumn(
        "status", F.when(F.col("_done"), "APPROVED_AND_APPLIED").otherwise(F.col("status"))
    ).drop("_done")
    change = learning.apply_proposal(policy, proposals, evidence, proposal_id, approved_by, rationale, timestamp)
    # All rows are worked out before the first write, because they depend on the approvals table.
    ready = {name: cut_lineage(change[name]) for name in ("policy", "exceptions", "history", "ledger", "approvals")}
    lake.add_snapshot(ready["policy"], "policy", timestamp)
    sinks.append(ready["exceptions"], lake.path("policy_exceptions"))
    sinks.append(ready["history"], lake.path("policy_history"))
    sinks.append(ready["ledger"], lake.path("ledger"), PARTITIONS)
    sinks.append(ready["approvals"], lake.path("approvals"))
    return current_policy(spark, lake)
