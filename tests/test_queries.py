"""Every query with a SQL equivalent, compared at the smallest scale."""

import re
from pathlib import Path

import pytest
from check_queries import compare, connect

import __spark_entry__ as entry

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="test tables are absent")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("key", sorted(entry.oracle_sql()))
def test_query_equals_its_sql(spark, con, key):
    ok, text = compare(spark, con, SF_DIR, key)
    assert ok, text


def test_entry_runs(spark):
    assert entry.entry(spark).count() == 5


def test_comments_never_meet_all_documents(spark, capsys):
    """The only join without keys has one row on a side."""
    entry.queries()["hourly_activity"](spark, SF_DIR).explain()
    plan = capsys.readouterr().out
    assert len(re.findall("NestedLoopJoin|CartesianProduct", plan)) == 1
    assert "doc_ref" in plan
