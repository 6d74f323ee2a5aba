"""Driver contract and oracle agreement on the smallest test data."""

import os

import pytest

import __spark_entry__ as E
from tests.oracle_check import compare

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")


def test_contract_names_match():
    names = set(E.queries())
    assert set(E.oracle_sql()) <= names
    # Only the optional training-data queries may lack SQL.
    assert all(n in E.oracle_sql() for n in names if n != "pipeline" and not n.startswith("op"))


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "views_7d" in df.columns and "published_date" in df.columns


@pytest.mark.parametrize("name", ["weekly_scorecard", "dim_book", "author_parse", "bridge_book_author",
                                  "fct_author_views_7d", "dim_date", "report_weekly_kpi",
                                  "check_relationships", "check_between", "fct_pageviews_daily_dedup", "report_export_round_trip"])
def test_matches_oracle(spark, name):
    r = compare(spark, name, SF)
    assert r["ok"], (r["rows"], r["cols"], r["hash_match"])
