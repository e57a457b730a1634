"""Every registered query is well formed; a sample agrees with its SQL on the smallest tables."""

import sys
from pathlib import Path

import duckdb
import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tools"))

import __spark_entry__ as entry  # noqa: E402
from check_queries import TABLES, row_hashes  # noqa: E402

SMALL = Path("/root/testdata/sf0.001")
SAMPLE = (
    "W1_session_metrics", "A2_usertag_report", "A8_source_pivot", "A31_console_report", "X2_tfidf_keywords",
    "X5_trend_catalogue_match", "F19_traffic_source", "K2_merge_into", "S3_glued_json", "Z2_two_hour_buckets",
    "E1_pageview_hours", "X14_forecast",
)

needs_tables = pytest.mark.skipif(not SMALL.exists(), reason="test tables are not mounted")


def test_oracles_belong_to_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(entry.queries()) > 180


@needs_tables
@pytest.mark.parametrize("name", SAMPLE)
def test_query_agrees_with_sql(spark, name):
    duck = duckdb.connect()
    for table in TABLES:
        duck.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    got = entry.queries()[name](spark, str(SMALL)).toPandas()
    want = duck.sql(entry.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert row_hashes(got) == row_hashes(want)


@needs_tables
def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0


@needs_tables
@pytest.mark.parametrize("name", ["W1_session_metrics", "A5_keyword_rollup", "X4_keyword_similarity", "X7_match_ads", "E3_subscriber_tags"])
def test_plans_have_no_cross_product(spark, name):
    plan = entry.queries()[name](spark, str(SMALL))._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "BatchEvalPython" not in plan
