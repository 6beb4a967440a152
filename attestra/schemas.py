"""Published table schemas, as DDL."""

BRONZE_META = (
    "contract_version string, run_id string, source_file string, source_sha256 string, "
    "source_api_version string, ingested_at string, record_index bigint, record_hash string, "
    "schema_fingerprint string"
)
BRONZE = f"_bronze struct<{', '.join(p.strip().replace(' ', ':', 1) for p in BRONZE_META.split(','))}>, payload string"

RUNS = (
    "run_id string, attempt int, source_file string, source_sha256 string, source_api_version string, "
    "ingested_at string, status string, records_in_source bigint, records_written bigint, "
    "unique_record_hashes bigint, duplicates_from_replay bigint, schema_fingerprint string, "
    "contract_version string, source string, source_metadata string, completed_at string, "
    "records_rejected bigint, delivery_guarantee string, landing string"
)
SNAPSHOTS = (
    "source_file string, source_sha256 string, run_id string, length bigint, content binary, ingested_at string, landing string"
)
REJECTS = (
    "reject_id string, run_id string, attempt int, source_file string, source_sha256 string, source_api_version string, "
    "ingested_at string, record_index bigint, byte_offset bigint, bytes bigint, reason string, raw binary, landing string"
)
CORRECTIONS = "reject_id string, payload string, corrected_by string"
RESOLUTIONS = "reject_id string, corrected_by string, resolved_at string, outcome string, reason string, record_hash string"

INVENTORY = "path string, types array<string>, present_count bigint, null_count bigint, values array<string>"

REGISTRY = (
    "source string, api_version string, fingerprint string, first_seen string, last_seen string, "
    "last_run_id string, record_count bigint, is_latest boolean"
)
REGISTRY_INVENTORY = f"source string, api_version string, {INVENTORY}"

REVIEW_HISTORY = (
    "struct<reviews:array<struct<reviewer:string,date:string,action:string,notes:string>>,"
    "review_count:int,last_review_date:string>"
)
LINEAGE = (
    "struct<run_id:string,source_file:string,source_api_version:string,record_index:bigint,"
    "record_hash:string,ingested_at:string>"
)
SILVER = (
    "clause_id string, contract_id string, client_name string, project_name string, "
    "clause_category string, clause_text string, section_ref string, effective_date string, "
    "expiration_date string, status string, last_modified string, modified_by string, "
    f"review_history {REVIEW_HISTORY}, _unmapped_fields array<string>, _lineage {LINEAGE}"
)

# Where a Silver row is stored: its review category, and the day it was landed.
SILVER_PLACE = "review_group string, landed_on string"

FINDING = (
    "struct<risk:string,severity:string,confidence:double,standard_reference:string,"
    "observed:string,expected:string,suggested_alternative:string,precedent_clause_ids:array<string>>"
)

POLICY = (
    "version string, position int, section string, key string, value string, "
    "severity_if_breached string, rationale string, acceptable_language_example string, "
    "trigger_phrases array<string>"
)

USAGE = "struct<input_tokens:bigint,output_tokens:bigint,total_tokens:bigint,cost_usd:double>"
LEDGER = (
    "timestamp string, agent string, clause_id string, action string, model_output string, "
    "human_decision string, effective_value string, decided_by string, status string, "
    "run_id string, trace_id string, span_id string, prompt_version string, model_name string, "
    "rubric_version string, firm_standards_version string, "
    f"usage {USAGE}, latency_ms double, lineage {LINEAGE}, detail string, seq bigint, idempotency_key string"
)
# One row for each record a run has assessed: what later runs need to know without reading its text.
ASSESSED = (
    f"clause_id string, record_hash string, {SILVER_PLACE}, category string, clean boolean, "
    "scope_reason string, policy_version string, timestamp string, run_id string"
)
FINDING_CHANGES = (
    "clause_id string, record_hash string, version_from string, version_to string, standard_reference string, "
    "change string, severity_before string, severity_after string, observed_before string, observed_after string, "
    "expected_before string, expected_after string"
)

REVIEWS = (
    "clause_id string, reviewer string, date string, action string, field string, "
    "human_value string, rationale string, source string, position bigint"
)
SIMULATED_REVIEWS = (
    "clause_id string, reviewer string, date string, action string, field string, "
    "human_value string, rationale string, note string"
)
LABELS = (
    "clause_id string, expected_category string, should_flag boolean, "
    "expected_standards array<string>, notes string"
)
CACHE = "key string, value string"
SPANS = (
    "name string, trace_id string, span_id string, parent_span_id string, start_time string, "
    "end_time string, duration_ms double, status string"
)
LOGS = "timestamp string, severity string, event string, body string, trace_id string, span_id string"

OVERRIDES = (
    "override_id string, clause_id string, agent string, reviewer string, date string, field string, model_value string, "
    f"human_value string, rationale string, source string, findings array<{FINDING}>, seq bigint, record_hash string"
)
