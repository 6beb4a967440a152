import random

import pytest
from pyspark.sql import types as T

from attestra.llm.common import prepared

SF_DIR = "/root/testdata/sf0.001"

# The columns of ``documents`` and extra ones named like those that operators make.
SCHEMA = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType())]
    + [T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())]
    + [T.StructField(n, T.StringType()) for n in ("row_key", "key", "fp", "start", "size", "kept", "words", "removed", "ids", "id", "row")]
)


def row(doc_id, text, lang="en", source="s"):
    return (doc_id, text, lang, source, None if text is None else len(text), *["x"] * 11)


def awkward_rows():
    """Nulls in every column, empty and very long texts, ties and repeated rows."""
    rng = random.Random(7)
    words = [f"w{k}" for k in range(400)]

    def prose(n):
        return " ".join(rng.choice(words) for _ in range(n))

    copy, passage = prose(60), prose(40)
    rows = [row(k, prose(rng.randint(1, 120)) + "\n" + prose(30)) for k in range(40)]
    rows += [row(100 + k, copy) for k in range(30)] + [row(5, copy), row(5, copy), row(5, "other text under a used id " + prose(20))]
    rows += [row(200 + k, prose(20) + "\n" + passage + "\n" + prose(9)) for k in range(6)]
    rows += [row(300, None), row(301, ""), row(None, "a text without an id " + prose(30)), row(None, None), row(302, " \n\t\n ")]
    rows += [(303, prose(30), None, None, None, *[None] * 11), row(304, "Word"), row(304, "Word"), row(305, "two words")]
    rows += [row(400, prose(30_000)), row(401, "x" * 120_000), row(402, "7" * 50_000 + " end"), row(403, "\n".join(prose(7) for _ in range(3000)))]
    return rows


@pytest.fixture(scope="module")
def awkward(spark):
    return prepared(spark).createDataFrame(awkward_rows(), SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def nothing(spark):
    return prepared(spark).createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def sample(spark):
    return prepared(spark).read.parquet(f"{SF_DIR}/documents.parquet")
