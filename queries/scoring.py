"""Scores of simple heuristics on the documents against the labels."""

from pyspark.sql import functions as F

from attestra.operators import evaluation
from queries import query

PREDICTED = "CASE WHEN n_chars > 800 THEN 'good' WHEN n_chars > 300 THEN 'poor' END"
CONFIDENCE = "least(95, n_chars // 100) / 100"


def scored(t):
    predicted = t.documents.select(
        F.col("doc_id").alias("clause_id"),
        F.expr("CASE WHEN n_chars > 800 THEN 'good' WHEN n_chars > 300 THEN 'poor' END").alias("predicted"),
        (F.least(F.lit(95), F.floor(F.col("n_chars") / 100)) / 100).alias("confidence"),
        F.col("lang").alias("decided_by"),
    )
    labels = t.labels.select(
        F.col("doc_id").alias("clause_id"), F.when(F.col("quality") == 1, "good").otherwise("poor").alias("expected")
    )
    return evaluation.scored(predicted, labels)


SCORED = f"""r AS (SELECT doc_id, {PREDICTED} AS predicted, least(95, n_chars // 100)::DOUBLE / 100::DOUBLE AS confidence, lang AS decided_by,
  CASE WHEN quality = 1 THEN 'good' ELSE 'poor' END AS expected FROM documents JOIN labels USING (doc_id)),
s AS (SELECT *, coalesce(predicted = expected, false) AS correct FROM r)"""


@query("eval_accuracy", f"WITH {SCORED} SELECT count(*) AS n, count(*) FILTER (correct) AS correct, round(avg(correct::INT), 4) AS accuracy FROM s")
def _(t):
    return evaluation.accuracy(scored(t))


@query(
    "eval_by_path",
    f"WITH {SCORED} SELECT decided_by, count(*) AS n, count(*) FILTER (correct) AS correct, round(avg(correct::INT), 4) AS accuracy FROM s GROUP BY 1",
)
def _(t):
    return evaluation.accuracy(scored(t), ["decided_by"])


@query(
    "eval_calibration",
    f"""WITH {SCORED} SELECT decided_by, round(avg(confidence) FILTER (correct AND confidence <> 0), 4) AS mean_confidence_when_correct,
  round(avg(confidence) FILTER (NOT correct AND confidence <> 0), 4) AS mean_confidence_when_wrong FROM s GROUP BY 1""",
)
def _(t):
    return evaluation.calibration(scored(t), ["decided_by"])


@query(
    "eval_confusion",
    f"WITH {SCORED} SELECT expected, coalesce(predicted, 'none') AS predicted, count(*) AS records FROM s WHERE NOT correct GROUP BY 1, 2",
)
def _(t):
    return evaluation.confusion(scored(t))


PRF = """round(CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END, 4) AS precision, round(CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END, 4) AS recall,
  round(CASE WHEN tp > 0 THEN 2.0::DOUBLE * (tp / (tp + fp)) * (tp / (tp + fn)) / ((tp / (tp + fp)) + (tp / (tp + fn))) ELSE 0 END, 4) AS f1"""


@query(
    "eval_flags",
    f"""WITH r AS (SELECT n_chars < 500 AS flagged, toxic = 1 AS should_flag FROM documents JOIN labels USING (doc_id)),
m AS (SELECT count(*) FILTER (flagged AND should_flag) AS tp, count(*) FILTER (flagged AND NOT should_flag) AS fp,
  count(*) FILTER (NOT flagged AND should_flag) AS fn FROM r)
SELECT tp AS true_positives, fp AS false_positives, fn AS false_negatives, {PRF} FROM m""",
)
def _(t):
    rows = t.documents.join(t.labels, "doc_id").select(
        (F.col("n_chars") < 500).alias("flagged"), (F.col("toxic") == 1).alias("should_flag")
    )
    return evaluation.flag_scores(rows)


def standards(t):
    """Found: the language and, for short texts, ``short``; expected from the labels."""
    pick = lambda *tests: F.array_compact(F.array(*[F.when(c, F.lit(v)) for v, c in tests]))
    return t.documents.join(t.labels, "doc_id").select(
        "doc_id",
        pick(("en", F.col("lang") == "en"), ("short", F.col("n_chars") < 500), ("fr", F.col("lang") == "fr")).alias("found"),
        pick(("en", F.col("quality") == 1), ("short", F.col("toxic") == 1)).alias("expected_standards"),
    )


STANDARDS = """r AS (SELECT doc_id, list_filter([CASE WHEN lang = 'en' THEN 'en' END, CASE WHEN n_chars < 500 THEN 'short' END, CASE WHEN lang = 'fr' THEN 'fr' END], lambda z: z IS NOT NULL) AS found,
  list_filter([CASE WHEN quality = 1 THEN 'en' END, CASE WHEN toxic = 1 THEN 'short' END], lambda z: z IS NOT NULL) AS expected
  FROM documents JOIN labels USING (doc_id)),
s AS (SELECT *, list_filter(expected, lambda z: NOT list_contains(found, z)) AS missed, list_filter(found, lambda z: NOT list_contains(expected, z)) AS spurious FROM r)"""


@query(
    "eval_standards",
    f"""WITH {STANDARDS}, m AS (SELECT sum(len(found) - len(spurious))::BIGINT AS tp, sum(len(spurious))::BIGINT AS fp, sum(len(missed))::BIGINT AS fn FROM s)
SELECT tp AS true_positives, fp AS false_positives, fn AS false_negatives, {PRF} FROM m""",
)
def _(t):
    return evaluation.standard_scores(standards(t))


@query(
    "eval_disagreements",
    f"""WITH {STANDARDS} SELECT doc_id, array_to_string(list_sort(missed), ',') AS missed, array_to_string(list_sort(spurious), ',') AS spurious
FROM s WHERE len(missed) + len(spurious) > 0""",
)
def _(t):
    found = evaluation.disagreements(standards(t), "doc_id")
    return found.select("doc_id", F.array_join("missed", ",").alias("missed"), F.array_join("spurious", ",").alias("spurious"))
