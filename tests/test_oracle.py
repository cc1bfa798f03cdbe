"""Every registered query equals its DuckDB oracle SQL (order-insensitive)."""

from __future__ import annotations

import pytest
from conftest import SF_ORACLE, SF_SMALL
from oracle_compare import compare, duck

import __spark_entry__ as entry_mod

from streakline.plans import ORACLE_SQL, QUERIES

NAMES = sorted(QUERIES)


def test_every_query_has_an_oracle():
    assert set(ORACLE_SQL) == set(NAMES) <= set(entry_mod.queries())


def test_entry_runs(spark):
    df = entry_mod.entry(spark)
    assert df.columns == ["Breakdown_Type", "Count_Successive", "Breakdowns_Level"]
    assert df.count() > 0


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, name):
    ok, info = compare(QUERIES[name](spark, SF_ORACLE), duck(SF_ORACLE), ORACLE_SQL[name])
    assert ok, info


def test_bucketed_queries_on_the_smallest_tables(spark):
    """Too few rows to cut: the plain forms answer the same queries."""
    for name in ("timeline_runs_bucketed", "timeline_run_pieces"):
        ok, info = compare(QUERIES[name](spark, SF_SMALL), duck(SF_SMALL), ORACLE_SQL[name])
        assert ok, info
