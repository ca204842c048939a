"""Every registered query at the smallest scale, against its oracle SQL."""

import pytest

import __spark_entry__ as entry
from suite import QUERIES
from suite.check import compare


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, data, name):
    outcome, _, _ = compare(spark, data, name)
    assert outcome in ("match", "rows only")


def test_registry():
    assert set(QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert len(rows) == 16 and all(r["status"] == "completed" for r in rows)
    assert [r["mode"] for r in rows[:4]] == ["full", "full", "incremental", "incremental"]
