"""Every registered query against its SQL twin on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from tests import sqlcheck

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def connection():
    pytest.importorskip("duckdb")
    return sqlcheck.duck(SF_DIR)


OWN = [name for name, query in entry.queries().items() if query.__module__ == entry.__name__]


@pytest.mark.parametrize("name", OWN)
def test_query_equals_sql(spark, connection, name):
    frame = entry.queries()[name](spark, SF_DIR)
    ours, theirs = sqlcheck.compare(connection, frame, entry.oracle_sql()[name])
    assert ours == theirs
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_entry(spark):
    found = entry.entry(spark)
    assert found.columns == ["video_id", "caption", "num_frames", "duration_sec"]
    assert found.count() == 200
