"""Landing: hashes, envelopes, manifests, attempts, documents."""

from pyspark.sql import functions as F

from attestra.functions import json_values
from attestra.operators import landing, quarantine
from attestra.sources.documents import checked_records, records_only, split_documents
from attestra.sources.tables import completed_only
from queries import query

def event_payload():
    """Keys out of order and a nested object: canonical form has work to do."""
    return F.to_json(
        F.struct(
            "user_id",
            "event_type",
            F.round(F.col("value") * 100).cast("bigint").alias("value_cents"),
            F.from_json("props", "k int").alias("props"),
            "event_id",
        )
    )


def kind_payload():
    return F.to_json(F.struct(F.from_json("props", "k int").alias("props"), "event_type"))


EVENT_JSON = """concat('{"event_id":', event_id, ',"event_type":"', event_type, '","props":',
  replace(props, ' ', ''), ',"user_id":', user_id, ',"value_cents":', CAST(round(value * 100) AS BIGINT), '}')"""
KIND_JSON = """concat('{"event_type":"', event_type, '","props":', replace(props, ' ', ''), '}')"""


@query("bronze_record_hash", f"SELECT event_id, concat('sha256:', sha256({EVENT_JSON})) AS record_hash FROM events")
def _(t):
    return t.spread("events").select("event_id", json_values.record_hash(event_payload()).alias("record_hash"))


@query(
    "bronze_envelope",
    f"""SELECT strftime(ts, '%Y-%m-%d') AS run_id, '1.0.0' AS contract_version, 'events.parquet' AS source_file,
       event_id AS record_index, strftime(ts, '%Y-%m-%dT%H:%M:%S.') || lpad(CAST(millisecond(ts) % 1000 AS VARCHAR), 3, '0') || 'Z' AS ingested_at,
       concat('sha256:', sha256({EVENT_JSON})) AS record_hash
FROM events""",
)
def _(t):
    records = t.spread("events").select(
        F.date_format("ts", "yyyy-MM-dd").alias("run_id"),
        F.lit("events.parquet").alias("source_file"),
        F.lit("").alias("source_sha256"),
        F.lit("1").alias("source_api_version"),
        F.col("event_id").alias("record_index"),
        F.lit("").alias("schema_fingerprint"),
        event_payload().alias("payload"),
        "ts",
    )
    return landing.envelope(records, json_values.utc_millis(F.col("ts"))).select(
        "run_id",
        "_bronze.contract_version",
        "_bronze.source_file",
        "_bronze.record_index",
        "_bronze.ingested_at",
        "_bronze.record_hash",
    )


@query(
    "bronze_dedupe",
    f"""SELECT concat('sha256:', sha256({KIND_JSON})) AS record_hash, min(event_id) AS event_id
FROM events GROUP BY 1""",
)
def _(t):
    # Every landing of the error events is replayed once; equal payloads are the same record.
    events = t.spread("events").select(
        "event_id", json_values.record_hash(kind_payload()).alias("record_hash"), "event_type", F.lit(0).alias("replay")
    )
    replayed = events.where(F.col("event_type") == "error").withColumn("replay", F.lit(1))
    landed = events.unionByName(replayed)
    return landing.keep_first(landed, "record_hash", ("event_id", "replay")).select("record_hash", "event_id")


@query(
    "run_manifest",
    f"""SELECT strftime(ts, '%Y-%m-%d') AS run_id, count(*) AS records_written,
       count(DISTINCT {KIND_JSON}) AS unique_record_hashes,
       count(*) - count(DISTINCT {KIND_JSON}) AS duplicates_from_replay
FROM events GROUP BY 1""",
)
def _(t):
    landed = t.spread("events").select(
        F.date_format("ts", "yyyy-MM-dd").alias("run_id"),
        json_values.record_hash(kind_payload()).alias("record_hash"),
    )
    return landing.run_manifest(landed, ("run_id",), "record_hash")


def runs_of(events):
    """A user's events are a run; a run whose last event is an error is unfinished."""
    return events.groupBy(F.col("user_id").alias("run_id")).agg(
        F.when(F.max_by("event_type", "event_id") == "error", "in_progress").otherwise("complete").alias("status")
    )


RUNS = """runs AS (SELECT user_id AS run_id,
  CASE WHEN arg_max(event_type, event_id) = 'error' THEN 'in_progress' ELSE 'complete' END AS status
  FROM events GROUP BY 1)"""


@query(
    "completed_bronze",
    f"""WITH {RUNS} SELECT event_type, count(*) AS records FROM events JOIN runs ON user_id = run_id
WHERE status = 'complete' GROUP BY 1""",
)
def _(t):
    bronze = t.events.select("event_type", F.col("user_id").alias("run_id"))
    return completed_only(bronze, runs_of(t.events)).groupBy("event_type").agg(F.count(F.lit(1)).alias("records"))


@query(
    "resume_points",
    f"""WITH {RUNS} SELECT run_id, max(event_id) + 1 AS resume_from_index FROM events JOIN runs ON user_id = run_id
WHERE status = 'in_progress' GROUP BY 1""",
)
def _(t):
    open_runs = runs_of(t.events).where("status = 'in_progress'").select("run_id")
    landed = t.events.select(F.col("user_id").alias("run_id"), F.col("event_id").alias("record_index"))
    return landing.resume_points(landed.join(open_runs, "run_id", "left_semi"))


@query(
    "latest_attempt",
    """SELECT conv_id, turn AS attempt, role FROM conversations
QUALIFY turn = max(turn) OVER (PARTITION BY conv_id)""",
)
def _(t):
    attempts = t.conversations.select("conv_id", F.col("turn").alias("attempt"), "role")
    return landing.latest_attempt(attempts, attempts.select("conv_id", "attempt"), "conv_id")


DOCUMENT = """concat('{"metadata":{"source":"orders"', CASE WHEN o_orderstatus = 'F' THEN ',"api_version":"2.1"' ELSE '' END,
 '}', CASE o_orderstatus
  WHEN 'F' THEN concat(',"clauses":[{"clause_id":"', CAST(o_orderkey AS STRING), '-a"}]')
  WHEN 'O' THEN concat(',"clauses":[{"clause_id":"', CAST(o_orderkey AS STRING), '-a"},{"clause_id":"', CAST(o_orderkey AS STRING), '-b"}]')
  ELSE '' END, '}')"""


@query(
    "document_records",
    """SELECT o_orderkey, 'orders' AS source, CASE WHEN o_orderstatus = 'F' THEN '2.1' ELSE 'unknown' END AS source_api_version,
  CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 2 END::BIGINT AS records_in_source, i::BIGINT AS record_index,
  o_orderkey || CASE WHEN i = 0 THEN '-a' ELSE '-b' END AS clause_id
FROM orders, (VALUES (0), (1)) n(i)
WHERE o_orderstatus = 'O' OR (o_orderstatus = 'F' AND i = 0)""",
)
def _(t):
    documents = t.spread("orders").select("o_orderkey", F.expr(DOCUMENT).alias("document"))
    split = split_documents(documents.withColumn("content", F.col("document").cast("binary")), ("o_orderkey",))
    return records_only(checked_records(split)).select(
        "o_orderkey",
        "source",
        "source_api_version",
        "records_in_source",
        "record_index",
        F.get_json_object("payload", "$.clause_id").alias("clause_id"),
    )


@query(
    "source_digest",
    """SELECT doc_id, sha256(text) AS source_sha256,
  concat('doc_', doc_id, '__', substr(sha256(text), 1, 8)) AS run_id FROM documents""",
)
def _(t):
    digest = json_values.sha256_hex(F.col("text"))
    path = F.concat(F.lit("/in/doc_"), F.col("doc_id"), F.lit(".json"))
    return t.documents.select(
        "doc_id", digest.alias("source_sha256"), json_values.run_id(path, digest).alias("run_id")
    )


# A user's events as one document.  Errors lost their closing brace, sign-ups hold a word that is no JSON
# value, views name a field twice: each is a reject of its own kind, and the records around them are landed.
BROKEN = """CASE event_type
  WHEN 'error' THEN concat('{"event_id":', CAST(event_id AS STRING), ',"props":', replace(props, ' ', ''))
  WHEN 'signup' THEN concat('{"event_id":', CAST(event_id AS STRING), ',"value":nil}')
  WHEN 'view' THEN concat('{"event_id":', CAST(event_id AS STRING), ',"event_id":0}')
  ELSE concat('{"event_id":', CAST(event_id AS STRING), ',"props":', replace(props, ' ', ''), '}') END"""
REJECTED = f"""r AS (SELECT user_id, event_type, event_id, {BROKEN} AS text,
  row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS from_end FROM events)"""


def broken_documents(t):
    records = t.events.select("user_id", F.struct("event_id", F.expr(BROKEN).alias("text")).alias("r"))
    listed = records.groupBy("user_id").agg(F.sort_array(F.collect_list("r")).alias("rs"))
    text = F.concat(F.lit('{"metadata":{"source":"events"},"clauses":['), F.array_join("rs.text", ","), F.lit("]}"))
    return listed.select("user_id", text.cast("binary").alias("content"))


@query(
    "quarantine_rejects",
    f"""WITH {REJECTED} SELECT user_id,
  CASE event_type WHEN 'error' THEN 'unclosed_record' WHEN 'signup' THEN 'malformed_record' ELSE 'duplicate_fields' END AS reason,
  count(*) AS records,
  CAST(sum(strlen(text) + CASE WHEN event_type = 'error' AND from_end = 1 THEN 2 ELSE 0 END) AS BIGINT) AS bytes
FROM r WHERE event_type IN ('error', 'signup', 'view') GROUP BY ALL""",
)
def _(t):
    split = checked_records(split_documents(broken_documents(t), ("user_id",)))
    refused = split.where("record_index is not null and reason is not null")
    return quarantine.reject_counts(refused, "user_id").drop("parts")


@query(
    "quarantine_manifest",
    f"""WITH {REJECTED} SELECT user_id, count(*) AS records_in_source,
  count(*) FILTER (event_type IN ('click', 'purchase')) AS records_written,
  count(*) FILTER (event_type NOT IN ('click', 'purchase')) AS records_rejected
FROM r GROUP BY user_id""",
)
def _(t):
    split = checked_records(split_documents(broken_documents(t), ("user_id",)))
    records = F.count_if(F.col("record_index").isNotNull() & F.col("reason").isNull())
    return split.groupBy("user_id").agg(
        F.max("records_in_source").alias("records_in_source"),
        records.alias("records_written"),
        F.count_if(F.col("record_index").isNotNull() & F.col("reason").isNotNull()).alias("records_rejected"),
    )
