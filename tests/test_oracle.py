"""Every registered query against its SQL on the smallest tables."""

from pathlib import Path

import pytest

import __spark_entry__ as entry
from tests import oracle

SF_DIR = "/root/testdata/sf0.001"
QUERIES = entry.queries()
ORACLE = entry.oracle_sql()

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF_DIR)


def test_every_sql_has_its_query():
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF_DIR)
    assert oracle.compare(df, con, ORACLE[name]) is None
    assert oracle.compare_types(df, con, ORACLE[name]) is None


def test_entry(spark):
    assert entry.entry(spark).count() > 0
