"""Every registered query against its DuckDB statement on the sf0.001 tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as se  # noqa: E402
from opsmetrics import registry  # noqa: E402
from check_oracle import duck, rows_of  # noqa: E402

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


@pytest.fixture(scope="module")
def con():
    return duck(SF)


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
                 "timestamp_ntz": "TIMESTAMP", "date": "DATE", "boolean": "BOOLEAN"}


# The optional subpackage tests its own statements under tests/llm.
@pytest.mark.parametrize("key", sorted(registry.oracle_sql()))
def test_query_matches_oracle(spark, con, key):
    df = se.queries()[key](spark, SF)
    rel = con.sql(se.oracle_sql()[key])
    assert sorted(df.columns) == sorted(rel.columns)
    duck_types = dict(zip(rel.columns, map(str, rel.types)))
    assert {n: SPARK_TO_DUCK.get(t, t) for n, t in df.dtypes} == duck_types
    assert rows_of(df.collect(), df.columns) == rows_of(rel.fetchall(), rel.columns)


def test_every_query_has_oracle_or_is_listed():
    missing = set(registry.queries()) - set(se.oracle_sql())
    assert not missing, missing


def test_entry(spark):
    df = se.entry(spark)
    assert df.count() > 0
    assert "picking_eph" in df.columns
