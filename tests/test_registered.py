"""Registered queries against their SQL. FULL=1 runs all of them; otherwise one or two per family."""

import os

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from oracle import compare, connect

FOLDER = os.environ.get("ORACLE_DIR", "/root/testdata/sf0.001")
SOME = [
    "flagship", "panel_daily", "fill_gaps", "forward_fill", "drop_gappy_series", "scan_panel", "dataset_status",
    "cv_wide_to_long", "union_forecasts", "contract_cast", "contract_nulls", "top_n_series", "subset_policy",
    "join_actuals_to_horizon", "gap_percentiles", "histogram_fixed", "interval_width_hist", "exact_quantiles",
    "roll_std_l7_w28", "roll_q25_l7_w28", "training_matrix", "category_codes", "cv_folds", "refit_policy",
    "recursive_linear", "ets_simple", "sample_path_summary", "conformal_interval_seasonal", "score_forecasts",
    "champion_challenger", "best_candidate", "feature_backfill", "abc_tiers", "stream_daily_panel",
    "coverage_drift", "user_forecaster", "naive", "filter_min_history", "filter_positive_total", "batch_scoring_ahead",
    "feature_snapshot", "feature_backfill_table", "backfill_overwrite", "contract_score", "scan_raw_csv",
    "partitioned_append", "fallback_forecast", "fallback_events",
]
NAMES = sorted(oracle_sql()) if os.environ.get("FULL") else SOME


@pytest.fixture(scope="module")
def db():
    return connect(FOLDER)


@pytest.mark.parametrize("name", NAMES)
def test_same_as_sql(spark, db, name):
    assert compare(queries()[name](spark, FOLDER), db, oracle_sql()[name]) == ""


def test_entry(spark):
    rows = {r["model"]: r for r in entry(spark).collect()}
    assert rows["Naive"]["wMAPE"] == 1.0 and rows["Naive"]["Bias"] == -1.0
    assert rows["SeasonalNaive"]["wMAPE"] == pytest.approx(1.625646, abs=1e-6)
    # 206 units too few on 5,802 sold
    assert rows["SeasonalNaive"]["Bias"] == pytest.approx(-206 / 5802, abs=1e-6)


def test_every_sql_has_a_query():
    assert set(oracle_sql()) <= set(queries())
