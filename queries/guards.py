"""Scope, budget and failure guards; tokens, prices, cache; telemetry."""

from pyspark.sql import functions as F

from attestra.functions import cost
from attestra.functions.text import render_prompt
from attestra.operators import cache, classify, guardrails, telemetry
from queries import query

REFUSAL = """CASE WHEN NOT regexp_matches(text, '[^\\s]') THEN 'empty_clause_text' WHEN length(text) < 20 THEN 'clause_too_short'
  WHEN length(text) > 20000 THEN 'clause_too_long' END"""


@query("scope_refusals", f"SELECT doc_id, {REFUSAL} AS reason FROM documents WHERE {REFUSAL} IS NOT NULL")
def _(t):
    return t.documents.select("doc_id", classify.scope_refusal(F.col("text")).alias("reason")).where("reason IS NOT NULL")


@query("scope_summary", f"SELECT coalesce({REFUSAL}, 'in_scope') AS reason, count(*) AS records FROM documents GROUP BY 1")
def _(t):
    reason = F.coalesce(classify.scope_refusal(F.col("text")), F.lit("in_scope"))
    return t.documents.groupBy(reason.alias("reason")).agg(F.count(F.lit(1)).alias("records"))


@query(
    "category_gates",
    """SELECT lang, lang IN ('en', 'fr') AS allowed, lang = 'en' AS bearing, count(*) AS records FROM documents GROUP BY 1""",
)
def _(t):
    return t.documents.groupBy(
        "lang",
        classify.category_allowed(F.col("lang"), ("en", "fr")).alias("allowed"),
        classify.risk_bearing(F.col("lang"), ("en",)).alias("bearing"),
    ).agg(F.count(F.lit(1)).alias("records"))


TOKENS = "greatest(1, floor(length(text) / 4))::BIGINT"
PRICE = f"round(({TOKENS} / 1000000.0::DOUBLE) * 3.0::DOUBLE + (8 / 1000000.0::DOUBLE) * 15.0::DOUBLE, 8)::DECIMAL(28,8)"


@query(
    "token_cost",
    f"""SELECT source, count(*) AS calls, 0::BIGINT AS errors, sum({TOKENS})::BIGINT AS input_tokens, (8 * count(*))::BIGINT AS output_tokens,
  (sum({TOKENS}) + 8 * count(*))::BIGINT AS total_tokens, round(sum({PRICE}), 6)::DOUBLE AS cost_usd FROM documents GROUP BY 1""",
)
def _(t):
    calls = t.documents.select(
        "source", cost.usage(cost.token_estimate(F.col("text")), F.lit(8)).alias("u")
    ).select("source", "u.*")
    return cache.usage_totals(calls, ["source"])


def spending(t):
    tokens = cost.token_estimate(F.col("text")) + 8
    return t.documents.select(
        "doc_id",
        tokens.alias("tokens"),
        cost.price(cost.token_estimate(F.col("text")), F.lit(8)).alias("cost_usd"),
    )


SPEND = f"""s AS (SELECT doc_id, {TOKENS} + 8 AS tokens, {PRICE} AS cost_usd FROM documents),
r AS (SELECT doc_id, tokens, cost_usd, coalesce(sum(tokens) OVER w, 0)::BIGINT AS tokens_before, coalesce(sum(cost_usd) OVER w, 0) AS cost_before
  FROM s WINDOW w AS (ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))"""


@query(
    "running_spend",
    f"WITH {SPEND} SELECT doc_id, tokens, tokens_before, cost_before::DOUBLE AS cost_before FROM r",
)
def _(t):
    spent = guardrails.running_spend(spending(t), ["doc_id"])
    return spent.select("doc_id", "tokens", "tokens_before", F.col("cost_before").cast("double").alias("cost_before"))


MAX_TOKENS, MAX_COST = 150_000, 0.5


@query(
    "budget_halt",
    f"""WITH {SPEND} SELECT doc_id AS halt_doc_id, 'budget_exceeded' AS halt_reason FROM r
WHERE tokens_before >= {MAX_TOKENS} OR cost_before >= {MAX_COST} ORDER BY doc_id LIMIT 1""",
)
def _(t):
    spent = guardrails.running_spend(spending(t), ["doc_id"])
    return guardrails.first_halt(spent, ["doc_id"], guardrails.budget_reason(MAX_TOKENS, MAX_COST))


@query(
    "budget_warning",
    f"""WITH {SPEND} SELECT doc_id, tokens_before, cost_before::DOUBLE AS cost_before FROM r
WHERE greatest(tokens_before / {MAX_TOKENS}, (cost_before / {MAX_COST})::DOUBLE) >= 0.8
  AND tokens_before < {MAX_TOKENS} AND cost_before < {MAX_COST} ORDER BY doc_id LIMIT 1""",
)
def _(t):
    spent = guardrails.running_spend(spending(t), ["doc_id"])
    found = guardrails.budget_warning(spent, ["doc_id"], MAX_TOKENS, MAX_COST)
    return found.withColumn("cost_before", F.col("cost_before").cast("double"))


def attempts(t):
    return t.events.select("user_id", "event_id", "event_type", (F.col("event_type") == "error").alias("failed"))


STATE = """e AS (SELECT user_id, event_id, event_type, event_type = 'error' AS failed FROM events),
f AS (SELECT *, row_number() OVER u - 1 AS processed_before, sum(failed::INT) OVER u - failed::INT AS failures_before,
  row_number() OVER u AS n FROM e WINDOW u AS ({part} ORDER BY event_id)),
k AS (SELECT *, coalesce(max(CASE WHEN NOT failed THEN n END) OVER ({part} ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS last_ok FROM f),
s AS (SELECT user_id, event_id, failed, processed_before::BIGINT AS processed_before, failures_before::BIGINT AS failures_before,
  (n - 1 - last_ok)::BIGINT AS streak_before FROM k)"""
BY_USER, GLOBAL = STATE.format(part="PARTITION BY user_id"), STATE.format(part="")


@query("failure_state", f"WITH {GLOBAL} SELECT event_id, failed, processed_before, failures_before, streak_before FROM s")
def _(t):
    rows = attempts(t).select("event_id", "failed")
    return guardrails.failure_state(rows, ["event_id"])


@query(
    "kill_switch",
    f"""WITH {BY_USER}, h AS (SELECT *, CASE WHEN streak_before >= 3 THEN 'consecutive_failures'
   WHEN processed_before >= 8 AND failures_before / processed_before > 0.25 THEN 'error_rate' END AS halt_reason FROM s)
SELECT user_id, min(event_id) AS halt_event_id, arg_min(halt_reason, event_id) AS halt_reason FROM h WHERE halt_reason IS NOT NULL GROUP BY 1""",
)
def _(t):
    state = guardrails.failure_state(attempts(t), ["event_id"], group=["user_id"])
    return guardrails.first_halt(state, ["event_id"], guardrails.kill_reason(), ["user_id"])


@query(
    "guarded_run",
    f"""WITH {BY_USER}, h AS (SELECT *, CASE WHEN streak_before >= 3 THEN 'consecutive_failures'
   WHEN processed_before >= 8 AND failures_before / processed_before > 0.25 THEN 'error_rate' WHEN processed_before * 10 >= 500 THEN 'budget_exceeded' END AS reason FROM s),
m AS (SELECT user_id, min(event_id) AS halt_at, arg_min(reason, event_id) AS why FROM h WHERE reason IS NOT NULL GROUP BY 1)
SELECT s.event_id, coalesce(s.event_id < halt_at, true) AS admitted, CASE WHEN s.event_id >= halt_at THEN why END AS halt_reason
FROM s LEFT JOIN m USING (user_id)""",
)
def _(t):
    rows = attempts(t).select("user_id", "event_id", "failed", F.lit(10).alias("tokens"), F.lit(0).alias("cost_usd"))
    return guardrails.guard_run(rows, ["event_id"], ["user_id"], max_tokens=500).select(
        "event_id", "admitted", "halt_reason"
    )


@query(
    "guard_snapshot",
    f"""WITH {SPEND}, a AS (SELECT *, tokens_before < {MAX_TOKENS} AND cost_before < {MAX_COST} AS ok FROM r)
SELECT (sum(tokens) FILTER (ok))::BIGINT AS tokens_spent, round(sum(tokens) FILTER (ok) / {MAX_TOKENS}, 4) AS tokens_fraction,
  round(sum(cost_usd) FILTER (ok), 6)::DOUBLE AS cost_usd_spent, round((sum(cost_usd) FILTER (ok))::DOUBLE / {MAX_COST}::DOUBLE, 4) AS cost_fraction,
  count(*) FILTER (ok) AS processed, count(*) FILTER (NOT ok) AS not_processed,
  CASE WHEN count(*) FILTER (NOT ok) > 0 THEN 'budget_exceeded' END AS tripped_reason FROM a""",
)
def _(t):
    rows = spending(t).withColumn("failed", F.lit(False))
    guarded = guardrails.guard_run(rows, ["doc_id"], max_tokens=MAX_TOKENS, max_cost=MAX_COST)
    return guardrails.guard_snapshot(guarded, max_tokens=MAX_TOKENS, max_cost=MAX_COST).select(
        "tokens_spent", "tokens_fraction", "cost_usd_spent", "cost_fraction", "processed", "not_processed", "tripped_reason"
    )


@query(
    "failure_rate",
    """SELECT user_id, count(*) AS processed, count(*) FILTER (event_type = 'error') AS failures,
  round(avg(CASE WHEN event_type = 'error' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 4) AS failure_rate FROM events GROUP BY 1""",
)
def _(t):
    return guardrails.failure_rate(attempts(t), group=["user_id"])


TEMPLATE = "Classify {this} text.\n\nTEXT:\n{clause_text}\n"


@query(
    "cache_keys",
    """SELECT doc_id, substr(sha256(concat('m|v1|Classify {this} text.', chr(10), chr(10), 'TEXT:', chr(10), text, chr(10))), 1, 32) AS key,
  greatest(1, floor(length(concat('Classify {this} text.', chr(10), chr(10), 'TEXT:', chr(10), text, chr(10))) / 4))::BIGINT AS prompt_tokens FROM documents""",
)
def _(t):
    prompt = render_prompt(TEMPLATE, {"clause_text": F.col("text")})
    return t.documents.select(
        "doc_id",
        cost.cache_key(prompt, F.lit("m"), F.lit("v1")).alias("key"),
        cost.token_estimate(prompt).alias("prompt_tokens"),
    )


def requests(t):
    return t.documents.select("doc_id", "lang", cost.cache_key(F.col("text"), F.lit("m"), F.lit("v1")).alias("key"))


def store(t):
    """The cache holds what the labelled, good documents said."""
    good = t.labels.where("quality = 1").select("doc_id")
    return requests(t).join(good, "doc_id", "left_semi").groupBy("key").agg(F.min("lang").alias("value"))


STORE = """k AS (SELECT doc_id, lang, substr(sha256(concat('m|v1|', text)), 1, 32) AS key FROM documents),
store AS (SELECT key, min(lang) AS value FROM k WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 1) GROUP BY 1)"""


@query(
    "cache_lookup",
    f"WITH {STORE} SELECT doc_id, value, value IS NOT NULL AS cache_hit FROM k LEFT JOIN store USING (key)",
)
def _(t):
    return cache.lookup(requests(t), store(t)).select("doc_id", "value", "cache_hit")


@query(
    "cache_hit_rate",
    f"""WITH {STORE} SELECT lang, count(value) AS hits, count(*) - count(value) AS misses, round(count(value) / count(*), 4) AS hit_rate
FROM k LEFT JOIN store USING (key) GROUP BY 1""",
)
def _(t):
    return cache.hit_rate(cache.lookup(requests(t), store(t)), ["lang"])


@query(
    "cache_write_back",
    f"WITH {STORE} SELECT key, min(lang) AS value FROM k WHERE key NOT IN (SELECT key FROM store) GROUP BY 1",
)
def _(t):
    return cache.new_entries(requests(t).withColumnRenamed("lang", "value"), store(t))


@query(
    "response_usage",
    """SELECT event_id, CASE event_type WHEN 'click' THEN user_id WHEN 'view' THEN user_id ELSE 0 END AS input_tokens,
  CASE event_type WHEN 'click' THEN 7 WHEN 'view' THEN 9 ELSE 0 END::BIGINT AS output_tokens,
  CASE event_type WHEN 'click' THEN user_id + 7 WHEN 'view' THEN user_id + 9 ELSE 0 END AS total_tokens FROM events""",
)
def _(t):
    user = F.col("user_id").cast("string")
    current = F.concat(
        F.lit('{"usage_metadata":{"input_tokens":'), user, F.lit(',"output_tokens":7,"total_tokens":'),
        (F.col("user_id") + 7).cast("string"), F.lit("}}"),
    )
    older = F.concat(
        F.lit('{"usage_metadata":{},"llm_output":{"token_usage":{"prompt_tokens":'), user, F.lit(',"completion_tokens":9}}}')
    )
    response = F.when(F.col("event_type") == "click", current).when(F.col("event_type") == "view", older).otherwise("{}")
    return t.spread("events").select("event_id", cost.response_usage(response).alias("u")).select("event_id", "u.*")


@query(
    "metric_histograms",
    """WITH r AS (SELECT event_type, value, row_number() OVER (PARTITION BY event_type ORDER BY value, event_id) AS rn,
  count(*) OVER (PARTITION BY event_type) AS n FROM events)
SELECT event_type, count(value) AS "count", round(sum(value), 3) AS "sum", round(min(value), 3) AS "min", round(max(value), 3) AS "max",
  round(avg(value), 3) AS "avg", round(max(value) FILTER (rn = least(n - 1, floor(n * 0.95::DOUBLE)) + 1), 3) AS p95 FROM r GROUP BY 1""",
)
def _(t):
    rows = t.events.select("event_type", "value", "event_id")
    return telemetry.histograms(rows, "event_type", "value", ["event_id"])


@query("metric_counters", "SELECT event_type AS name, sum(user_id)::BIGINT AS total FROM events GROUP BY 1")
def _(t):
    return telemetry.counters(t.events.select(F.col("event_type").alias("name"), F.col("user_id").alias("value")))


SPANS = "sp AS (SELECT user_id, min(event_id) AS span_id FROM events WHERE event_type = 'signup' GROUP BY 1)"


def spans(t):
    """A user's first signup opens the user's span."""
    return (
        t.events.where("event_type = 'signup'")
        .groupBy(F.col("user_id").cast("string").alias("trace_id"))
        .agg(F.min("event_id").cast("string").alias("span_id"))
        .withColumn("name", F.concat(F.lit("span "), "span_id"))
        .withColumn("status", F.lit("OK"))
    )


def logs(t):
    """Signups name themselves as span, so only the first of each user is correlated."""
    return t.events.select(
        "event_id",
        "event_type",
        F.col("user_id").cast("string").alias("trace_id"),
        F.when(F.col("event_type") == "signup", F.col("event_id").cast("string")).alias("span_id"),
    )


@query(
    "log_span_join",
    f"""WITH {SPANS} SELECT event_id, event_type, CASE WHEN sp.span_id IS NOT NULL THEN 'span ' || sp.span_id END AS span_name
FROM events e LEFT JOIN sp ON e.user_id = sp.user_id AND e.event_id = sp.span_id AND e.event_type = 'signup'""",
)
def _(t):
    return telemetry.logs_with_spans(logs(t), spans(t)).select("event_id", "event_type", "span_name")


@query(
    "uncorrelated_logs",
    f"WITH {SPANS} SELECT event_id FROM events WHERE event_type = 'signup' AND event_id NOT IN (SELECT span_id FROM sp)",
)
def _(t):
    return telemetry.uncorrelated(logs(t), spans(t)).select("event_id")
