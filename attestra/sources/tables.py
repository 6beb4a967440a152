"""Table scans: Bronze, Silver, aliases, policy, labels, ledger, cache, registry, telemetry."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from attestra import schemas


def read_or_empty(spark: SparkSession, path: str, ddl: str, fmt: str = "parquet") -> DataFrame:
    """A table that may not exist yet: missing means empty, never an error."""
    try:
        return spark.read.schema(ddl).format(fmt).load(path)
    except AnalysisException as missing:
        if "PATH_NOT_FOUND" in str(missing):
            return spark.createDataFrame([], ddl)
        raise


def spread(df: DataFrame) -> DataFrame:
    """Deal a small scan out to all cores before costly per-row work.

    Only a scan with fewer input splits than cores is shuffled, so the rows moved are bounded by
    cores x split size; a large table has more splits than cores and is left as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def completed_only(bronze: DataFrame, runs: DataFrame, run_col: str = "run_id") -> DataFrame:
    """Rows of finished runs.  A run that has no row in ``runs`` is not skipped."""
    unfinished = runs.where(F.col("status") != "complete").select(F.col("run_id").alias(run_col))
    return bronze.join(unfinished, run_col, "left_anti")


def read_bronze(spark: SparkSession, path: str, runs_path: str | None = None) -> DataFrame:
    """Landed records, oldest run first by (ingest_date, run_id, record_index) when sorted."""
    ddl = f"{schemas.BRONZE}, attempt int, run_id string, ingest_date string, landing string"
    bronze = spark.read.schema(ddl).parquet(path)
    if runs_path is None:
        return bronze
    return completed_only(bronze, read_or_empty(spark, runs_path, schemas.RUNS))


def read_silver(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Silver as Parquet, JSON lines (``json``) or a JSON document with ``clauses`` (``document``)."""
    if fmt == "document":
        text = spark.read.text(path, wholetext=True)
        parsed = F.from_json("value", f"clauses array<struct<{_as_struct(schemas.SILVER)}>>")
        return text.select(F.inline(parsed["clauses"]))
    rows = spark.read.schema(schemas.SILVER).format(fmt).load(path)
    return rows.drop("review_group", "landed_on")


def _as_struct(ddl: str) -> str:
    """Top-level ``name type`` pairs to ``name:type``."""
    out, depth, field = [], 0, ""
    for ch in ddl + ",":
        depth += (ch == "<") - (ch == ">")
        if ch == "," and depth == 0:
            name, kind = field.strip().split(" ", 1)
            out.append(f"{name}:{kind}")
            field = ""
        else:
            field += ch
    return ",".join(out)


def load_aliases(spark: SparkSession, path: str) -> DataFrame:
    """Alias rows ``(source_field, target, ...)`` a named person has confirmed."""
    text = spark.read.text(path, wholetext=True)
    entry = "struct<target:string,seen_in_api_version:string,confirmed_by:string,confirmed_at:string,note:string>"
    return confirmed_aliases(
        text.select(F.explode(F.from_json("value", f"aliases map<string,{entry}>")["aliases"]).alias("source_field", "e"))
        .select("source_field", "e.*")
    )


def confirmed_aliases(aliases: DataFrame) -> DataFrame:
    return aliases.where(F.col("confirmed_by").isNotNull() & (F.col("confirmed_by") != ""))


def load_policy(spark: SparkSession, path: str) -> DataFrame:
    """A nested policy document as one row per standard."""
    text = spark.read.text(path, wholetext=True)
    entry = (
        "struct<value:string,severity_if_breached:string,rationale:string,"
        "acceptable_language_example:string,trigger_phrases:array<string>>"
    )
    parsed = F.from_json("value", f"version string, standards map<string,map<string,{entry}>>")
    return (
        text.select(parsed.alias("p"))
        .select("p.version", F.posexplode("p.standards").alias("i", "section", "rules"))
        .select("version", "i", "section", F.posexplode("rules").alias("j", "key", "r"))
        .select(
            "version",
            (F.col("i") * 1000 + F.col("j")).alias("position"),
            "section",
            "key",
            "r.value",
            "r.severity_if_breached",
            "r.rationale",
            "r.acceptable_language_example",
            "r.trigger_phrases",
        )
    )


def load_simulated_reviews(spark: SparkSession, path: str) -> DataFrame:
    text = spark.read.text(path, wholetext=True)
    parsed = F.from_json("value", f"reviews array<struct<{_as_struct(schemas.SIMULATED_REVIEWS)}>>")
    return text.select(F.posexplode(parsed["reviews"]).alias("position", "r")).select(
        "r.*", F.col("position").cast("bigint").alias("position")
    )


def load_labels(spark: SparkSession, path: str) -> DataFrame:
    """Ground truth ``{labels: {clause_id: {...}}}`` as rows."""
    text = spark.read.text(path, wholetext=True)
    entry = "struct<expected_category:string,should_flag:boolean,expected_standards:array<string>,notes:string>"
    parsed = F.from_json("value", f"labels map<string,{entry}>")["labels"]
    return text.select(F.explode(parsed).alias("clause_id", "l")).select("clause_id", "l.*")


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    return read_or_empty(spark, path, schemas.LEDGER)


def read_cache(spark: SparkSession, path: str) -> DataFrame:
    """Decision cache; unreadable files count as missing entries, never as an error."""
    try:
        return spark.read.option("ignoreCorruptFiles", "true").schema(schemas.CACHE).parquet(path)
    except AnalysisException:
        return spark.createDataFrame([], schemas.CACHE)


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    return read_or_empty(spark, path, schemas.REGISTRY)


def read_registry_inventory(spark: SparkSession, path: str) -> DataFrame:
    return read_or_empty(spark, path, schemas.REGISTRY_INVENTORY)


def supersession_map(proposals: DataFrame) -> DataFrame:
    """``superseded -> superseding`` from supersession candidates only, one row an id."""
    return (
        proposals.where(F.col("kind") == "SUPERSESSION_CANDIDATE")
        .groupBy(F.col("superseded_clause_id").alias("clause_id"))
        .agg(F.max("superseding_clause_id").alias("superseded_by"))
    )
