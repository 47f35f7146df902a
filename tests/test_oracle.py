"""Queries against their SQL. WAYFACT_ALL=1 runs every one of them."""

import os

import pytest

import __spark_entry__ as entry
from oracle_check import compare, duck
from wayfact.plans.oracle import oracle
from wayfact.plans.registry import registered

DIRECTORY = "/root/testdata/sf0.001"
SAMPLE = """
    scan_partition_pruned range_generate hour_spine schema_report catalog_partitioned_table
    busiest_hours_sql roundtrip_partitioned roundtrip_json csv_to_parquet clean_trips_daily
    quality_report payment_label enrich_sort_merge dedupe_dimension missing_hours join_quality
    revenue_by_method pivot_method_by_hour top_zones word_top_no_stopwords trace_amount
    best_record_per_hour fill_neighbors fill_direction coverage_report daily_condition
    repair_then_median median_impute iqr_outliers zscore quartile_bins tip_quantiles
    event_log_metrics condition_summary monthly_borough_summary monthly_tipping_summary
    daily_demand report_period_compare report_hourly report_daily_vs_hourly report_top_zones
    tip_split areas_under_roc prepared_features logistic_optimum ranked_feature_names
    check_consistency label_high_demand label_distribution binary_metrics confusion_long
""".split()

pytestmark = pytest.mark.skipif(not os.path.isdir(DIRECTORY), reason="no test tables")
CHOSEN = sorted(oracle()) if os.environ.get("WAYFACT_ALL") else SAMPLE


@pytest.fixture(scope="module")
def connection():
    return duck(DIRECTORY)


@pytest.mark.parametrize("name", CHOSEN)
def test_matches_sql(spark, connection, name):
    frame = entry.queries()[name](spark, DIRECTORY)
    assert compare(frame, connection, entry.oracle_sql()[name]) == []


def test_names_agree():
    without_sql = set(registered()) - set(oracle())
    assert without_sql == {
        "demand_models", "feature_ranking", "permutation_importance", "storage_footprint", "tip_classifier"
    }
    assert set(registered()) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0
