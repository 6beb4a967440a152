"""Review Silver records: classify, check policy, guard the run, record decisions, publish."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from attestra import fixed_values as fixed
from attestra import schemas
from attestra.functions import cost
from attestra.functions.text import render_prompt
from attestra.operators import (
    cache as decision_cache,
)
from attestra.operators import (
    classify,
    guardrails,
    learning,
    ledger,
    precedents,
    register,
    rereview,
    residue,
    reviews,
    rules,
)
from attestra.operators.policy import BASELINE, Policy
from attestra.plans.lake import Lake
from attestra.session import cut_lineage
from attestra.sources import sinks
from attestra.sources.tables import supersession_map

ORDER = ("clause_id", "record_hash")


@dataclass(frozen=True)
class Prompt:
    version: str
    template: str


@dataclass(frozen=True)
class Settings:
    """Parameters of one review run; time and run id are given, never read from the clock."""

    run_id: str
    timestamp: str
    policy: Policy = BASELINE
    rules: rules.RuleSet = field(default_factory=lambda: rules.RULES)  # see rules.extended_rules
    model_name: str = "external"
    classifier: Prompt = Prompt("classifier.v1", "Classify this clause.\n\nCLAUSE TEXT:\n{clause_text}\n")
    assessor: Prompt = Prompt(
        "risk_flagger.v1",
        "Review this clause for risk.\n\nCATEGORY: {category}\n\nALREADY RAISED:\n{existing_findings}\n\n"
        "CLAUSE TEXT:\n{clause_text}\n",
    )
    prefer_rules: bool = True
    use_cache: bool = True
    max_tokens: int = fixed.MAX_TOTAL_TOKENS
    max_cost: float = fixed.MAX_COST_USD
    max_consecutive: int = fixed.MAX_CONSECUTIVE_FAILURES
    max_rate: float = fixed.MAX_FAILURE_RATE
    min_records: int = fixed.MIN_RECORDS_BEFORE_RATE_CHECK
    min_occurrences: int = fixed.MIN_OVERRIDES_FOR_PROPOSAL
    prices: Mapping[str, float] = field(
        default_factory=lambda: {
            "input_per_1m": fixed.INPUT_USD_PER_1M,
            "output_per_1m": fixed.OUTPUT_USD_PER_1M,
        }
    )


def _call(
    rows: DataFrame, name: str, needed: str, prompt: Column, version: str, answer: str, settings: Settings,
    cache: DataFrame | None, model: bool,
) -> DataFrame:
    """Attach one model call: content, cache key, who decided, usage.

    ``answer`` is a column of fresh model text.  Rows that do not need the call carry no key and
    join nothing; without a cache no key is worked out at all.  Without ``model`` there is no call: the
    answer is the built-in evidence, which has no prompt, no usage and no place in the cache.
    """
    wanted = F.col(needed)
    if not model:
        return (
            rows.withColumn(f"{name}_key", F.lit(None).cast("string"))
            .withColumn(f"{name}_content", F.when(wanted, F.col(answer)))
            .withColumn(f"{name}_hit", F.lit(False))
            .withColumn(f"{name}_usage", cost.no_usage())
            .withColumn(needed, F.lit(False))
        )
    keyed = rows.withColumn("_prompt", F.when(wanted, prompt))
    key = cost.cache_key(F.col("_prompt"), F.lit(settings.model_name), F.lit(version))
    keyed = (
        keyed.withColumn(f"{name}_key", F.when(wanted, key) if cache is not None else F.lit(None).cast("string"))
        .withColumn("_prompt_tokens", cost.token_estimate(F.col("_prompt")))
        .drop("_prompt")
    )
    looked = (
        decision_cache.lookup(keyed, cache, f"{name}_key", spread_by=("clause_id",))
        if cache is not None
        else decision_cache.lookup(keyed, keyed, enabled=False)
    )
    fresh = cost.usage(
        F.col("_prompt_tokens"),
        cost.token_estimate(F.coalesce(F.col(f"{name}_content"), F.lit(""))),
        **settings.prices,
    )
    return (
        looked.withColumn(f"{name}_content", F.when(wanted, F.coalesce("value", answer)))
        .withColumnRenamed("cache_hit", f"{name}_hit")
        .withColumn(
            f"{name}_usage", F.when(wanted & ~F.col(f"{name}_hit"), fresh).otherwise(cost.no_usage())
        )
        .drop("value", "_prompt_tokens")
    )


def _decider(name: str, model_outputs: DataFrame | None) -> Column:
    if model_outputs is None:
        return F.lit("evidence")
    return F.when(F.col(f"{name}_hit"), "cache").otherwise("model")


def assess(
    silver: DataFrame, settings: Settings, cache: DataFrame | None = None, model_outputs: DataFrame | None = None
) -> DataFrame:
    """Scope, classification, rule findings and the second pass for every record.

    ``model_outputs`` (``clause_id, classification, assessment`` as model text; those with a ``record_hash`` are
    for that record only and go first, of several the greatest texts count) are decided by ``model`` (or
    ``cache``) and cost what their tokens cost.  Without them the built-in keyword and wording evidence
    decides, booked as ``evidence`` and free of charge; this is map-only.
    """
    rows = silver.withColumn("record_hash", F.coalesce("_lineage.record_hash", F.lit(""))).withColumn(
        "scope_reason", classify.scope_refusal(F.col("clause_text"))
    )
    text = F.coalesce("clause_text", F.lit(""))
    lowered = F.lower(text)
    if model_outputs is not None:
        texts = F.max(F.struct(F.col("classification").alias("_class_text"), F.col("assessment").alias("_risk_text")))
        named = model_outputs.withColumn("record_hash", reviews.named_record(model_outputs))
        own = named.where("record_hash is not null").groupBy(*ORDER).agg(texts.alias("_own"))
        every = named.where("record_hash is null").groupBy("clause_id").agg(texts.alias("_every"))
        rows = rows.join(own, list(ORDER), "left").join(every, "clause_id", "left")
        rows = rows.withColumn("_given", F.coalesce("_own", "_every")).select("*", "_given.*").drop("_own", "_every", "_given")
    in_scope = F.col("scope_reason").isNull()
    ruled = F.coalesce(
        classify.review_category(F.col("clause_category")).isNotNull() & F.lit(settings.prefer_rules), F.lit(False)
    ) | F.coalesce(F.col("clause_category").isin(*fixed.KNOWN_UNMAPPED), F.lit(False))
    rows = rows.withColumn("_class_needed", in_scope & ~ruled)
    if model_outputs is None:
        rows = rows.withColumn("_own_class", F.when(F.col("_class_needed"), classify.by_keywords(lowered)))
        rows = rows.withColumn("_class_text", F.to_json("_own_class"))
    rows = _call(
        rows,
        "class",
        "_class_needed",
        render_prompt(settings.classifier.template, {"clause_text": text}),
        settings.classifier.version,
        "_class_text",
        settings,
        cache,
        model_outputs is not None,
    )
    parsed = residue.parse_classification(F.col("class_content"))
    rows = classify.classify(
        rows,
        prefer_rules=settings.prefer_rules,
        # Our own fresh answers are structs already; only texts from elsewhere are parsed.
        model=parsed if model_outputs is not None else F.col("_own_class"),
        model_decided_by=_decider("class", model_outputs),
    ).withColumn("review_category", F.when(in_scope, F.col("classification.category")))

    # The sweep for precedents covers refused records too, under their source's own category; a
    # record without one counts under ``other``, which has no rules.
    source_category = classify.review_category(F.col("clause_category"))
    rows = rows.withColumn("source_review_category", F.coalesce(source_category, F.lit("other"))).withColumn(
        "_rules_for", F.coalesce("review_category", source_category)
    )
    rows = rules.with_findings(rows, settings.policy, category="_rules_for", rules=settings.rules)
    agrees = F.coalesce(F.col("source_review_category") == F.col("_rules_for"), F.lit(False))
    clean = F.when(agrees, F.size("findings") == 0)
    if settings.prefer_rules:
        rows = rows.withColumn("clean", clean.otherwise(F.col("source_review_category") == "other"))
    else:
        # The model may have chosen another category: there the rules run again for the source's.
        rows = rows.withColumn("_again", F.when(~agrees, F.col("source_review_category")))
        rows = rules.with_findings(rows, settings.policy, category="_again", rules=settings.rules, output="_again_findings")
        rows = rows.withColumn("clean", clean.otherwise(F.size("_again_findings") == 0)).drop(
            "_again", "_again_findings"
        )
    rows = rows.drop("_rules_for")
    gated = in_scope & classify.risk_bearing(F.col("review_category"))
    lines = F.transform(
        "findings",
        lambda f: F.concat(F.lit("- ["), f["severity"], F.lit("] "), f["risk"], F.lit(" ("), f["standard_reference"], F.lit(")")),
    )
    existing = F.coalesce(F.nullif(F.array_join(lines, "\n"), F.lit("")), F.lit("(none)"))
    rows = rows.withColumn("_risk_needed", gated).withColumn("_gated_risk", gated)
    if model_outputs is None:
        rows = rows.withColumn("_own_risk", F.when(gated, residue.narrative_assessment(lowered)))
        rows = rows.withColumn("_risk_text", F.to_json("_own_risk"))
    rows = _call(
        rows,
        "risk",
        "_risk_needed",
        render_prompt(
            settings.assessor.template,
            {
                "category": F.coalesce("review_category", F.lit("")),
                "existing_findings": existing,
                "clause_text": text,
            },
        ),
        settings.assessor.version,
        "_risk_text",
        settings,
        cache,
        model_outputs is not None,
    )
    parsed = residue.parse_assessment(F.col("risk_content"))
    rows = residue.merge_assessment(
        rows,
        parsed if model_outputs is not None else F.col("_own_risk"),
        F.col("_gated_risk"),
        model_decided_by=_decider("risk", model_outputs),
    )
    return rows.withColumn(
        "tokens", F.col("class_usage.total_tokens") + F.col("risk_usage.total_tokens")
    ).withColumn(
        "cost_usd",
        F.col("class_usage.cost_usd").cast("decimal(28,8)") + F.col("risk_usage.cost_usd").cast("decimal(28,8)"),
    ).withColumn(
        "failed", in_scope & F.col("classification").isNull()
    ).drop("_class_text", "_risk_text", "_own_class", "_own_risk", "_gated_risk")


def _classification_payload() -> Column:
    return F.to_json("classification")


def _assessment_payload() -> Column:
    return F.to_json(
        F.struct(
            "findings",
            "overall_severity",
            F.col("risk_confidence").alias("confidence"),
            F.col("risk_notes").alias("notes"),
        )
    )


def decision_rows(admitted: DataFrame, settings: Settings) -> DataFrame:
    """Ledger rows of the admitted, in-scope records: one per classification and assessment."""
    reviewed = admitted.where(F.col("scope_reason").isNull())
    common = dict(
        run_id=settings.run_id,
        timestamp=settings.timestamp,
        clause_id=F.col("clause_id"),
        firm_standards_version=settings.policy.version,
        lineage=F.col("_lineage"),
    )
    by_model = lambda col: F.col(col) == "model"
    by_text = lambda col: F.col(col).isin("model", "cache")
    classified = ledger.ledger_rows(
        reviewed,
        agent="clause_classifier",
        action="classify_clause",
        decided_by=F.col("class_decided_by"),
        status=F.col("class_status"),
        model_output=_classification_payload(),
        effective_value=_classification_payload(),
        prompt_version=F.when(by_text("class_decided_by"), settings.classifier.version),
        model_name=F.when(by_model("class_decided_by"), settings.model_name),
        usage=F.col("class_usage"),
        detail=F.col("class_reason"),
        seq=F.col("processed_before") * 2,
        **common,
    )
    assessed = ledger.ledger_rows(
        reviewed.where(F.col("classification").isNotNull()),
        agent="risk_flagger",
        action="assess_risk",
        decided_by=F.col("risk_decided_by"),
        status=F.col("risk_status"),
        model_output=_assessment_payload(),
        effective_value=_assessment_payload(),
        prompt_version=F.when(by_text("risk_decided_by"), settings.assessor.version),
        model_name=F.when(by_model("risk_decided_by"), settings.model_name),
        usage=F.col("risk_usage"),
        detail=F.col("risk_reason"),
        seq=F.col("processed_before") * 2 + 1,
        **common,
    )
    return classified.unionByName(assessed)


def escalation_queue(admitted: DataFrame) -> DataFrame:
    """Everything a person must look at: refusals, open categories, low confidence, bad output; ``detail`` says why."""
    refused = F.format_string(
        "%s characters; texts from %s to %s characters are reviewed.",
        F.length(F.coalesce("clause_text", F.lit(""))), F.lit(fixed.MIN_CLAUSE_CHARS), F.lit(fixed.MAX_CLAUSE_CHARS),
    )
    confidence = F.round("classification.confidence", 2).cast("string")
    unclear = F.when(
        F.col("class_reason") == "low_confidence_classification",
        F.format_string("Read as %s with confidence %s.", F.col("classification.category"), confidence),
    ).otherwise(F.format_string("Source category: %s.", F.coalesce("clause_category", F.lit("none"))))
    weak = F.format_string("%s finding(s), worst %s.", F.size("findings"), F.coalesce("overall_severity", F.lit("none")))
    entries = F.array_compact(
        F.array(
            F.when(
                F.col("scope_reason").isNotNull(),
                F.struct(F.lit(0).alias("step"), F.lit("scope_guard").alias("agent"), F.col("scope_reason").alias("reason"), refused.alias("detail")),
            ),
            F.when(
                F.col("scope_reason").isNull() & F.col("class_reason").isNotNull(),
                F.struct(F.lit(1).alias("step"), F.lit("clause_classifier").alias("agent"), F.col("class_reason").alias("reason"), unclear.alias("detail")),
            ),
            F.when(
                F.col("scope_reason").isNull() & F.col("classification").isNotNull() & F.col("risk_reason").isNotNull(),
                F.struct(F.lit(2).alias("step"), F.lit("risk_flagger").alias("agent"), F.col("risk_reason").alias("reason"), weak.alias("detail")),
            ),
        )
    )
    return admitted.select("clause_id", "record_hash", F.inline(entries))


def decided_view(admitted: DataFrame) -> DataFrame:
    """Register columns of the admitted records."""
    usable = F.col("scope_reason").isNull() & F.col("classification").isNotNull()
    escalated = (
        F.col("scope_reason").isNotNull()
        | (F.col("class_status") == "escalated")
        | (usable & (F.col("risk_status") == "escalated"))
    )
    return admitted.select(
        "clause_id",
        "record_hash",
        "review_category",
        F.when(usable, F.col("classification.confidence")).alias("classification_confidence"),
        F.when(usable, F.col("class_decided_by")).alias("classification_decided_by"),
        F.when(usable, F.col("findings")).alias("findings"),
        F.when(usable, F.col("overall_severity")).alias("overall_severity"),
        F.when(escalated, "escalated").otherwise("proposed").alias("status"),
    )


POLICIES = f"{schemas.POLICY}"


def remember_policy(spark: SparkSession, lake: Lake, policy: Policy) -> None:
    """Keep the rows of every policy version that was used, for later comparisons."""
    known = lake.read(spark, "policies_used", POLICIES)
    if known.where(F.col("version") == policy.version).isEmpty():
        sinks.append(policy.to_rows(spark), lake.path("policies_used"))


def earlier_policies(spark: SparkSession, lake: Lake, policy: Policy) -> dict[str, Policy]:
    """The other versions by name: a policy is a few dozen rows, its versions are approvals by hand."""
    rows = lake.read(spark, "policies_used", POLICIES)
    names = [r.version for r in rows.where(F.col("version") != policy.version).select("version").distinct().collect()]
    return {name: Policy.from_rows(rows, name) for name in names}


def record_keys(silver: DataFrame) -> DataFrame:
    """Every record with its place: no text is read."""
    return silver.select("clause_id", F.coalesce("_lineage.record_hash", F.lit("")).alias("record_hash"), "review_group", "landed_on").distinct()


def last_assessed(spark: SparkSession, lake: Lake) -> DataFrame:
    """The newest row of each record in the index of assessed records."""
    rows = lake.read(spark, "assessed", schemas.ASSESSED)
    rest = [c for c in rows.columns if c not in ORDER]
    return rows.groupBy(*ORDER).agg(F.max_by(F.struct(*rest), F.struct("timestamp", "run_id")).alias("r")).select(*ORDER, "r.*")


def assessed_rows(assessed: DataFrame, settings: Settings) -> DataFrame:
    return assessed.select(
        *ORDER, "review_group", "landed_on", F.col("source_review_category").alias("category"), "clean", "scope_reason",
        F.lit(settings.policy.version).alias("policy_version"), F.lit(settings.timestamp).alias("timestamp"),
        F.lit(settings.run_id).alias("run_id"),
    )


def open_records(
    spark: SparkSession, lake: Lake, settings: Settings, keys: DataFrame, known: DataFrame, with_model: bool
) -> DataFrame:
    """Records without a decision that holds under the policy (and, with model texts, the prompts) of this run.

    A decision of an earlier policy version holds if no standard that changed since applies to its category.
    Refused records are not looked at again, whatever the policy: scope does not depend on it.
    """
    policy = settings.policy
    touched = rereview.touched_since(policy, earlier_policies(spark, lake, policy), settings.rules)
    decided = ledger.decided_under(known)
    holds = rereview.still_holds(F.col("policy_version"), F.col("category"), policy.version, touched)
    if with_model:
        for column, prompt in (("classifier_prompt", settings.classifier), ("assessor_prompt", settings.assessor)):
            holds = holds & (F.col(column).isNull() | (F.col(column) == prompt.version))
    refused = last_assessed(spark, lake).where("scope_reason is not null").select(*ORDER)
    return ledger.skip_done(ledger.skip_done(keys, decided.where(holds), *ORDER), refused, *ORDER)


def in_places(silver: DataFrame, wanted: DataFrame) -> DataFrame:
    """The rows of ``wanted`` records; only the places (category and day) that hold one are scanned."""
    places = wanted.select("review_group", "landed_on").distinct().collect()  # a row for each category and day
    here = F.lit(False)
    days: dict[str | None, list] = {}
    for p in places:
        days.setdefault(p.review_group, []).append(p.landed_on)
    for group, found in days.items():
        on = F.col("landed_on").isNull() if None in found else F.lit(False)
        on = on | F.col("landed_on").isin(*[d for d in found if d is not None])
        here = here | (F.col("review_group").eqNullSafe(F.lit(group).cast("string")) & on)
    asked = wanted.select("clause_id", F.col("record_hash").alias("_record"))
    same = (silver["clause_id"].eqNullSafe(asked["clause_id"])) & (F.coalesce(silver["_lineage.record_hash"], F.lit("")) == F.col("_record"))
    return silver.where(here).join(asked, same, "left_semi")


def rereview_changes(
    spark: SparkSession, lake: Lake, settings: Settings, first_day: str | None = None, last_day: str | None = None
) -> DataFrame:
    """What the policy of ``settings`` would change for records decided under other versions: nothing is written.

    Only places with a record that a changed standard can touch are read, between the given days of landing.
    """
    silver, known = lake.silver(spark), lake.read(spark, "ledger", schemas.LEDGER)
    policy = settings.policy
    touched = rereview.touched_since(policy, earlier_policies(spark, lake, policy), settings.rules)
    decided = ledger.decided_under(known)
    moved = decided.where(~rereview.still_holds(F.col("policy_version"), F.col("category"), policy.version, touched))
    keys = record_keys(silver)
    if first_day is not None:
        keys = keys.where(F.col("landed_on") >= first_day)
    if last_day is not None:
        keys = keys.where(F.col("landed_on") <= last_day)
    wanted = cut_lineage(keys.join(moved, list(ORDER), "left_semi"))
    rows = in_places(silver, wanted).withColumn("record_hash", F.coalesce("_lineage.record_hash", F.lit("")))
    rows = rows.join(moved.select(*ORDER, F.col("category").alias("review_category"), "policy_version"), list(ORDER))
    after = rules.with_findings(rows, policy, rules=settings.rules).select(*ORDER, "findings")
    # The second pass is not repeated: its findings name no standard of the policy and are left out here.
    state = ledger.rehydrate(known.where(F.col("agent").isin("clause_classifier", "risk_flagger")), ("timestamp", "seq"))
    references = {rule.reference for entries in settings.rules.values() for rule in entries}
    named = F.filter("findings", lambda f: f["standard_reference"].isin(*sorted(references)))
    changes = rereview.finding_changes(state.select(*ORDER, named.alias("findings")), after)
    versions = moved.select(*ORDER, F.col("policy_version").alias("version_from"), F.lit(policy.version).alias("version_to"))
    return changes.join(versions, list(ORDER)).select(*[f.split()[0] for f in schemas.FINDING_CHANGES.split(", ")])


def review(
    spark: SparkSession,
    lake: Lake,
    settings: Settings,
    simulated: DataFrame | None = None,
    model_outputs: DataFrame | None = None,
    acknowledged: str | None = None,
) -> DataFrame:
    """One review run over Silver; returns the published register.

    Records with a decision in the ledger that still holds (``open_records``) are skipped and read back from
    it; their texts are not read.  A run that
    follows a halted one needs ``acknowledged``, which goes into the ledger.
    """
    silver = lake.silver(spark)
    known = lake.read(spark, "ledger", schemas.LEDGER)
    halts = lake.read(spark, "halts", "run_id string, timestamp string, halt_reason string")
    last = halts.orderBy(F.desc("timestamp")).limit(1).collect()
    if last and last[0]["halt_reason"] is not None:
        if not acknowledged:
            raise RuntimeError(f"run {last[0]['run_id']} halted ({last[0]['halt_reason']}); acknowledge it first")
        row = learning.acknowledge_halt(
            spark, settings.run_id, acknowledged, last[0]["halt_reason"], settings.timestamp
        )
        sinks.append(row, lake.path("ledger"), ledger.PARTITIONS)

    # 1. Assess the records that are not done yet and keep that: all later steps read this table.
    cache = lake.read(spark, "cache", schemas.CACHE) if settings.use_cache else None
    remember_policy(spark, lake, settings.policy)
    keys = record_keys(silver)
    open_keys = cut_lineage(open_records(spark, lake, settings, keys, known, model_outputs is not None))
    table = lake.path(f"assessments/run={settings.run_id}")
    sinks.rebuild(assess(in_places(silver, open_keys), settings, cache, model_outputs), table)
    assessed = spark.read.parquet(table)

    # 2. Precedents from the clean records of the whole corpus, of which only the open ones were read now.
    sinks.replace_partition(assessed_rows(assessed, settings), lake.path("assessed"), "run_id")
    index = last_assessed(spark, lake).join(keys, list(ORDER), "left_semi")
    clean = index.where("clean").select("category", F.col("clause_id").alias("precedent_id"))
    open_rows = precedents.with_precedents(assessed, precedents.first_clean(clean))

    # 3. Guard them.
    guarded_table = lake.path(f"guarded/run={settings.run_id}")
    sinks.rebuild(
        guardrails.guard_run(
            open_rows,
            list(ORDER),
            max_tokens=settings.max_tokens,
            max_cost=settings.max_cost,
            max_consecutive=settings.max_consecutive,
            max_rate=settings.max_rate,
            min_records=settings.min_records,
        ),
        guarded_table,
    )
    guarded = spark.read.parquet(guarded_table)
    admitted = guarded.where("admitted")
    halted = guarded.agg(F.max("halt_reason").alias("halt_reason")).select(
        F.lit(settings.run_id).alias("run_id"), F.lit(settings.timestamp).alias("timestamp"), "halt_reason"
    )
    sinks.append(halted, lake.path("halts"))
    sinks.rebuild(
        guardrails.guard_snapshot(guarded, max_tokens=settings.max_tokens, max_cost=settings.max_cost),
        lake.path("guard_snapshot"),
    )

    # 4. Decisions, escalations, new cache entries.
    before = ledger.rehydrate(known.where(F.col("agent").isin("clause_classifier", "risk_flagger")), ("timestamp", "seq"))
    under = ledger.decided_under(known).select(*ORDER, F.col("policy_version").alias("version_from"))
    usable = admitted.where(F.col("classification").isNotNull())
    changes = rereview.finding_changes(before, usable.select(*ORDER, "findings")).join(under, list(ORDER))
    changes = changes.withColumn("version_to", F.lit(settings.policy.version)).where("version_from <> version_to")
    sinks.replace_partition(changes.withColumn("run_id", F.lit(settings.run_id)), lake.path("finding_changes"), "run_id")
    decisions = ledger.not_yet_recorded(decision_rows(admitted, settings), known)
    sinks.append(decisions, lake.path("ledger"), ledger.PARTITIONS)
    # Refused records are looked at again in every run; they are queued once.
    queued = lake.read(spark, "escalations", "clause_id string, record_hash string, agent string, reason string, detail string, seq bigint")
    waiting = escalation_queue(admitted).join(queued, [*ORDER, "agent", "reason"], "left_anti")
    sinks.append(
        reviews.escalation_ids(
            waiting.select("clause_id", "record_hash", "step", "agent", "reason", "detail"), [*ORDER, "step"], queued
        ),
        lake.path("escalations"),
    )
    if cache is not None:
        calls = admitted.where("classification is not null").select(
            F.inline(
                F.array(
                    F.struct(F.col("class_key").alias("key"), F.col("class_content").alias("value")),
                    F.struct(F.col("risk_key").alias("key"), F.col("risk_content").alias("value")),
                )
            )
        )
        fresh = decision_cache.new_entries(calls.where("key is not null"), cache)
        sinks.append(fresh, lake.path("cache"))

    sinks.rebuild(ledger.counts(lake.read(spark, "escalations", "reason string"), "reason"), lake.path("escalation_counts"))
    called = admitted.select(
        F.inline(
            F.array(
                F.struct(F.col("_class_needed").alias("called"), F.col("class_hit").alias("cache_hit"), F.col("class_usage").alias("u")),
                F.struct(F.col("_risk_needed").alias("called"), F.col("risk_hit").alias("cache_hit"), F.col("risk_usage").alias("u")),
            )
        )
    ).where("called")
    sinks.rebuild(decision_cache.hit_rate(called), lake.path("cache_stats"))
    sinks.rebuild(
        decision_cache.usage_totals(called.where("NOT cache_hit").select("u.*")), lake.path("usage_totals")
    )

    # 5. Human reviews against everything in the ledger, also from earlier runs.
    known = lake.read(spark, "ledger", schemas.LEDGER)
    state = ledger.rehydrate(known.where(F.col("agent").isin("clause_classifier", "risk_flagger")), ("timestamp", "seq"))
    sides = state.where("overall_severity is not null").join(ledger.completed(known), list(ORDER), "left_semi")
    sides = sides.select(*ORDER, "findings", "overall_severity", F.col("status").alias("risk_status"))
    reconciled = reviews.reconcile(reviews.human_reviews(silver, simulated), sides)
    recorded = lake.read(spark, "overrides", schemas.OVERRIDES)
    sinks.append(reviews.overrides(reconciled, recorded=recorded), lake.path("overrides"))
    overrides = lake.read(spark, "overrides", schemas.OVERRIDES)
    human_rows = ledger.not_yet_recorded(
        reviews.review_ledger_rows(reconciled, overrides, settings.run_id, settings.timestamp), known
    )
    sinks.append(human_rows, lake.path("ledger"), ledger.PARTITIONS)

    mine = lake.read(spark, "ledger", schemas.LEDGER).where(F.col("run_id") == settings.run_id)
    sinks.rebuild(ledger.counts(mine, "decided_by"), lake.path("decision_counts"))

    # 6. Proposals only: nothing below changes the policy.
    found = learning.learning_proposals(
        overrides, settings.policy.to_rows(spark), settings.timestamp, settings.min_occurrences
    )
    sinks.rebuild(found, lake.path("learning_proposals"))
    sinks.rebuild(
        learning.proposal_evidence(overrides, spark.read.parquet(lake.path("learning_proposals"))),
        lake.path("learning_evidence"),
    )

    # 7. The effective view.  Earlier runs' records come back from the ledger, refusals from now.
    now = decided_view(admitted)
    earlier = state.join(now.select(*ORDER), list(ORDER), "left_anti")
    decided = now.unionByName(earlier.select(*now.columns))
    # Records refused by an earlier run were not read again: they stay escalated.
    refused = index.where("scope_reason is not null").join(decided.select(*ORDER), list(ORDER), "left_anti")
    decided = decided.unionByName(refused.select(*ORDER, F.lit("escalated").alias("status")), allowMissingColumns=True)
    superseded = lake.read(
        spark,
        "supersession_proposals",
        "kind string, superseded_clause_id string, superseding_clause_id string",
    )
    gold = reviews.with_overrides(register.register(silver, decided, supersession_map(superseded)), overrides)
    sinks.rebuild(gold, lake.path("gold"))
    published = spark.read.parquet(lake.path("gold"))
    sinks.rebuild(run_report(published, guarded, called, settings, model_outputs is not None), lake.path("run_summary"))
    return published


def run_report(gold: DataFrame, guarded: DataFrame, called: DataFrame, settings: Settings, with_model: bool) -> DataFrame:
    """The register's totals with what this run was and cost, in one row."""
    stopped = guarded.agg(F.max("halt_reason").alias("halt_reason"))
    fresh = F.when(~F.col("cache_hit"), F.col("u.total_tokens"))
    dollars = F.when(~F.col("cache_hit"), F.col("u.cost_usd").cast("decimal(28,8)"))
    spent = called.agg(
        F.count(F.lit(1)).alias("model_calls"),
        F.count_if("cache_hit").alias("cache_hits"),
        F.count_if(~F.col("cache_hit")).alias("cache_misses"),
        F.coalesce(F.sum(fresh), F.lit(0)).alias("total_tokens"),
        F.coalesce(F.sum(dollars).cast("double"), F.lit(0.0)).alias("cost_usd"),
    )
    one = lambda df: df.withColumn("_one", F.lit(1))
    told = {
        "run_id": settings.run_id,
        "generated_at": settings.timestamp,
        "policy_version": settings.policy.version,
        "model_name": settings.model_name if with_model else None,
        "classifier_prompt": settings.classifier.version if with_model else None,
        "assessor_prompt": settings.assessor.version if with_model else None,
    }
    joined = one(register.run_summary(gold)).join(one(stopped), "_one").join(one(spent), "_one").drop("_one")
    return joined.withColumns(
        {
            **{name: F.lit(value).cast("string") for name, value in told.items()},
            "status": F.when(F.col("halt_reason").isNull(), "complete").otherwise("halted"),
            "cache_hit_rate": F.coalesce(F.try_divide("cache_hits", "model_calls"), F.lit(0.0)),
        }
    )
