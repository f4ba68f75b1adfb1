"""Every registered query against its SQL twin, on the smallest data."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from tools.check_oracles import TABLES, compare

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
ORACLES = entry.oracle_sql()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_equals_sql(spark, con, key):
    result = compare(entry.queries()[key](spark, SF_DIR), con, ORACLES[key])
    assert result.startswith("ok"), result


def test_entry(spark):
    assert set(ORACLES) <= set(entry.queries())
    assert entry.entry(spark).columns[:2] == ["skill_key", "skill_name"]
