"""Registered queries against their SQL in a second engine on the small tables."""

import os

import duckdb
import pytest

import __spark_entry__ as spark_entry
from tanisight.plans import catalog
from tools.check import TABLES, compare

QUERIES, SQL = spark_entry.queries(), spark_entry.oracle_sql()
# All of them run with CHECK_ALL=1 (or tools/check.py); a cross-section runs by default.
SAMPLE = [
    "gold_feature_store", "union_sources", "source_precedence", "bronze_merge", "feature_matrix_14d",
    "feature_matrix_timing", "asof_lead_time", "naive_backtest", "ts_folds", "strip_html", "signal_score",
    "keyword_velocity", "top_phrases", "risk_index", "alert_message", "alert_cooldown", "prediction_view",
    "situation_report", "recommendations", "scan_jsonl", "table_history", "ingest_manifest",
    "stream_daily_counts", "stream_quarantine", "stream_merge_bronze", "stream_news_velocity",
    "stream_cooldown_state", "source_precedence_runs", "macro_by_period", "macro_in_force",
]
NAMES = sorted(SQL) if os.environ.get("CHECK_ALL") else SAMPLE


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, sf, duck, name):
    message, n = compare(QUERIES[name](spark, sf), duck, SQL[name])
    assert message == "" and n > 0


def test_only_models_lack_sql():
    assert sorted(set(catalog.queries()) - set(catalog.oracle_sql())) == [
        "feature_importance", "forecast_7_14", "forecast_7d", "magnitude_quantiles", "model_vs_baseline",
        "timing_windows", "top_features",
    ]


def test_entry(spark):
    assert spark_entry.entry(spark).columns[:4] == ["date_parsed", "komoditas", "avg_price", "n_sources"]
