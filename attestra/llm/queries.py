"""The operators over the whole ``documents`` table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from attestra.llm.common import documents, prepared
from attestra.llm.conversation_trie import prefix_trie, turns_of
from attestra.llm.decontamination import overlaps
from attestra.llm.hard_negatives import integer_rows, mine
from attestra.llm.licenses import SEPARATOR, TEMPLATES, scan
from attestra.llm.line_dedup import line_report
from attestra.llm.packing import pack
from attestra.llm.pii import PATTERNS, find, told
from attestra.llm.quality import judge
from attestra.llm.secret_scan import KINDS as SECRETS
from attestra.llm.secret_scan import scan as scan_secrets
from attestra.llm.secret_scan import told as told_secrets
from attestra.llm.sharding import shard
from attestra.llm.simhash import near_duplicates
from attestra.llm.token_counts import count_tokens
from attestra.llm.token_files import read_token_files, write_token_files
from attestra.session import shared_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


# Lines as sets of words; similar ones share a word of their rarest-first prefix.
LINES_SQL = r"""
WITH line AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS k
  FROM documents
), bag AS (
  SELECT doc_id, k, list_distinct(list_filter(string_split_regex(
    translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '')) AS words
  FROM line
), small AS (
  SELECT doc_id, k, row_number() OVER (PARTITION BY list_sort(words) ORDER BY doc_id, k) AS r FROM bag WHERE len(words) BETWEEN 1 AND 4
), big AS (SELECT doc_id, k, list_sort(words) AS words, len(words) AS n FROM bag WHERE len(words) >= 5),
word AS (SELECT doc_id, k, n, words, unnest(words) AS w FROM big),
freq AS (SELECT w, count(*) AS f FROM word GROUP BY w),
ranked AS (
  SELECT doc_id, k, n, words, word.w, row_number() OVER (PARTITION BY doc_id, k ORDER BY f, word.w) AS r
  FROM word JOIN freq ON word.w = freq.w
), prefix AS (SELECT * FROM ranked WHERE r <= n - ((4 * n + 4) // 5) + 1),
pair AS (
  SELECT DISTINCT b.doc_id, b.k, b.words, a.doc_id AS a_id, a.k AS a_k, a.words AS a_words
  FROM prefix a JOIN prefix b ON a.w = b.w AND 5 * a.n >= 4 * b.n AND 5 * b.n >= 4 * a.n
    AND (a.doc_id < b.doc_id OR (a.doc_id = b.doc_id AND a.k < b.k))
), gone AS (
  SELECT DISTINCT doc_id, k FROM pair
  WHERE 9 * len(list_intersect(words, a_words)) >= 4 * (len(words) + len(a_words))
  UNION ALL SELECT doc_id, k FROM small WHERE r > 1
), lost AS (SELECT doc_id, count(*) AS n_removed, string_agg(CAST(k AS VARCHAR), ',' ORDER BY k) AS removed FROM gone GROUP BY doc_id)
SELECT d.doc_id, CAST(len(string_split(text, chr(10))) AS BIGINT) AS n_lines,
  CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(removed, '') AS removed
FROM documents d LEFT JOIN lost ON d.doc_id = lost.doc_id
"""


# Containment of the templates' shingles (five words, or all of a shorter template) in whole texts.
LICENSES_SQL = """
WITH given(template, license, text) AS (VALUES __TEMPLATES__),
t AS (
  SELECT template, license, list_filter(string_split_regex(lower(text), '__SEPARATOR__'), lambda w: w <> '') AS words FROM given
), sized AS (SELECT *, least(5, len(words)) AS size FROM t),
wanted AS (
  SELECT DISTINCT template, license, size, unnest(list_transform(range(1, CAST(len(words) - size + 2 AS BIGINT)),
    lambda k: array_to_string(words[k : k + size - 1], ' '))) AS shingle FROM sized
), total AS (SELECT template, license, size, count(*) AS n_shingles FROM wanted GROUP BY ALL),
d AS (SELECT doc_id, string_split_regex(lower(text), '__SEPARATOR__') AS words FROM documents),
sizes AS (SELECT DISTINCT size FROM sized),
held AS (
  SELECT DISTINCT doc_id, size, unnest(list_transform(range(1, greatest(1, CAST(len(words) - size + 2 AS BIGINT))),
    lambda k: array_to_string(words[k : k + size - 1], ' '))) AS shingle FROM d, sizes
), found AS (
  SELECT doc_id, template, count(*) AS n FROM held JOIN wanted ON held.size = wanted.size AND held.shingle = wanted.shingle GROUP BY ALL
)
SELECT doc_id, CAST(total.template AS INTEGER) AS template, license, CAST(n_shingles AS INTEGER) AS n_shingles,
  CAST(n AS INTEGER) AS n_found
FROM found JOIN total ON found.template = total.template WHERE n >= 0.8 * n_shingles
""".replace("__SEPARATOR__", SEPARATOR).replace(
    "__TEMPLATES__", ", ".join("({}, '{}', '{}')".format(k, n, t.replace("'", "''")) for k, (n, t) in enumerate(TEMPLATES))
)


# Rebuilt conversations as lists of turn digests; a prefix is the digests joined.  The checksum is made from its
# definition, a byte at a time.
TRIE_SQL = r"""
WITH RECURSIVE step(b, k, c) AS (
  SELECT b, 0, CAST(b AS BIGINT) FROM range(256) t(b)
  UNION ALL SELECT b, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM step WHERE k < 8
), ids AS (SELECT DISTINCT conv_id FROM conversations WHERE conv_id IS NOT NULL),
crc(conv_id, k, c) AS (
  SELECT conv_id, 0, CAST(4294967295 AS BIGINT) FROM ids
  UNION ALL
  SELECT crc.conv_id, crc.k + 1, xor(step.c, crc.c >> 8)
  FROM crc JOIN step ON step.k = 8 AND step.b = xor(crc.c & 255, CAST(ascii(substring(CAST(crc.conv_id AS VARCHAR), crc.k + 1, 1)) AS BIGINT))
  WHERE crc.k < length(CAST(crc.conv_id AS VARCHAR))
), heads AS (SELECT conv_id, xor(c, 4294967295) % 9 AS h FROM crc WHERE k = length(CAST(conv_id AS VARCHAR))),
turn AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
  FROM conversations WHERE conv_id IS NOT NULL
), rebuilt AS (
  SELECT heads.conv_id, pos, role, text FROM heads JOIN turn ON turn.conv_id = heads.conv_id - heads.conv_id % 5 AND pos <= h
  UNION ALL
  SELECT heads.conv_id, pos, role, text FROM heads JOIN turn ON turn.conv_id = heads.conv_id AND pos > h
), placed AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY pos) AS depth, strlen(text) AS size,
    sha256(CAST(strlen(role) AS VARCHAR) || ':' || role || text) AS id
  FROM rebuilt
), prefix AS (
  SELECT conv_id, 0 AS depth, '' AS path, CAST(NULL AS VARCHAR) AS parent, 0 AS size, CAST([] AS VARCHAR[]) AS above FROM ids
  UNION ALL
  SELECT conv_id, depth, array_to_string(list(id) OVER upto, '') AS path,
    coalesce(array_to_string(list(id) OVER before, ''), '') AS parent, size, list(id) OVER upto
  FROM placed
  WINDOW upto AS (PARTITION BY conv_id ORDER BY depth ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
    before AS (PARTITION BY conv_id ORDER BY depth ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), node AS (
  SELECT path, any_value(parent) AS parent, any_value(depth) AS depth, any_value(size) AS size, any_value(above) AS above,
    min(conv_id) AS conv_id, count(*) AS n_convs
  FROM prefix GROUP BY path
), kids AS (SELECT parent AS path, count(*) AS n_children FROM node WHERE parent IS NOT NULL GROUP BY parent),
last AS (SELECT conv_id, max(depth) AS depth FROM prefix GROUP BY conv_id),
ends AS (
  SELECT path, string_agg(CAST(prefix.conv_id AS VARCHAR), ',' ORDER BY prefix.conv_id) AS members
  FROM prefix JOIN last ON prefix.conv_id = last.conv_id AND prefix.depth = last.depth GROUP BY path
), up AS (
  SELECT node.path, unnest(range(0, len(above) + 1)) AS d, above, (n_convs - 1) * size AS saved, CASE WHEN n_children IS NULL THEN 1 ELSE 0 END AS leaf
  FROM node LEFT JOIN kids ON node.path = kids.path
), total AS (
  SELECT array_to_string(above[1:d], '') AS path, sum(saved) AS saved, sum(leaf) AS leaves FROM up GROUP BY 1
)
SELECT node.conv_id, CAST(node.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, node.n_convs, coalesce(n_children, 0) AS n_children,
  CAST(leaves AS BIGINT) AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens, sha256(coalesce(members, '')) AS ends_sha256
FROM node LEFT JOIN node p ON node.parent = p.path LEFT JOIN kids ON node.path = kids.path LEFT JOIN ends ON node.path = ends.path
JOIN total ON node.path = total.path
"""


# All inner products of anchors and rows; positives and negatives by rank.
NEGATIVES_SQL = """
WITH e AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
  FROM e a JOIN e b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
), p AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
)
SELECT p.anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, id) AS INTEGER) AS rank,
  id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10
"""


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return register


@query("op1_disclosure")
def disclosure(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find(documents(spark, sf_dir))
    kinds = F.transform("base", lambda s: s["kind"])
    counts = [(F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{k}") for k in PATTERNS]
    spans = told(F.concat("base", "added")).alias("spans")
    return found.select("doc_id", *counts, F.sha2(told(F.col("base")), 256).alias("base_sha256"), spans)


@query("op2_token_files")
def token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    files = write_token_files(docs, shared_folder(spark, "tokens"), public_tokenizers.path("word_bpe_49k.json"), end_id=1)
    return read_token_files(files).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query("op3_sampled_splitters")
def sampled_splitters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(documents(spark, sf_dir), shards=24).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


@query("op4_token_counts")
def token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = count_tokens(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))
    return counts.withColumn("over_limit", F.col("n_tokens") > 512)


@query("op5_power_of_two_packing")
def power_of_two_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    sequences = pack(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))
    return sequences.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


@query("op8_adaptive_quality")
def adaptive_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = judge(documents(spark, sf_dir))
    further = ("lang", "source", "n_stutter_words")
    return found.select(*[c for c in found.columns if c not in further], *further)


@query("op9_simhash_components")
def simhash_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(documents(spark, sf_dir))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query("op10_line_similarity", sql=LINES_SQL)
def line_similarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_report(documents(spark, sf_dir)).withColumn("removed", F.array_join("removed", ","))


@query("op6_spaced_seeds")
def spaced_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return overlaps(documents(spark, sf_dir), benchmark).drop("row_key")


@query("op7_license_bands", sql=LICENSES_SQL)
def license_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(documents(spark, sf_dir)).select("doc_id", "template", "license", "n_shingles", "n_found")


@query("op11_randomness")
def randomness(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_secrets(documents(spark, sf_dir))
    kinds = F.col("base.kind")
    counts = [(F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{n}") for k, n in enumerate(SECRETS[:3])]
    spans = told_secrets(F.concat("base", "added")).alias("spans")
    return found.select("doc_id", *counts, F.sha2(told_secrets(F.col("base")), 256).alias("base_sha256"), spans)


@query("op12_radix_trie", sql=TRIE_SQL)
def radix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = turns_of(prepared(spark).read.parquet(f"{sf_dir}/conversations.parquet"))
    # A conversation opens with the first h turns of the one whose id is the next lower multiple of five.
    heads = own.where("conv_id % 5 = 0").select(F.col("conv_id").alias("base"), F.slice("turns", 1, 8).alias("head"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 9).cast("int")
    rows = own.select("*", (F.col("conv_id") - F.col("conv_id") % 5).alias("base"), h.alias("h")).join(heads, "base", "left")
    head = F.slice(F.coalesce("head", F.array().cast("array<string>")), F.lit(1), F.col("h"))
    rest = F.slice("turns", F.col("h") + 1, F.greatest(F.lit(0), F.size("turns") - F.col("h")))
    return prefix_trie(rows.select("conv_id", F.concat(head, rest).alias("turns"))).drop("path", "parent")


@query("op13_threshold_algorithm", sql=NEGATIVES_SQL)
def threshold_algorithm(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = integer_rows(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(rows.withColumn("label", label), F.col("vec_id") % 100 == 0)
