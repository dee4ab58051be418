"""What the plans of the registered queries may and may not contain."""

import pytest

from dockflow.session import MB, sized_for
from parity.registry import QUERIES
from tests.conftest import SMALL

# These train models or write tables while they are built.
EAGER = {
    "train_compare", "feature_importance", "forecast_all", "forecast_totals", "kmeans_scan",
    "segment_profile_k4", "segment_profile_k3", "segment_hours_k3", "csv_roundtrip", "load_raw",
    "write_fact", "write_dims", "export_dispatch", "quality_report", "stream_incremental",
    "recent_rides", "quality_post_transform", "schema_tests_marts", "segment_durations_k4",
    "segment_weekend_k4", "given_profile_k4", "given_profile_k3", "given_hours_k3", "given_durations_k3",
    "given_weekend_k4", "key_findings_commuters", "training_extract", "fact_schema",
}
LAZY = sorted(set(QUERIES) - EAGER)


def plan(spark, name):
    return QUERIES[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_join_and_no_python_in_the_plan(spark, name):
    text = plan(spark, name)
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "EvalPython", "InPandas"):
        assert word not in text


@pytest.mark.parametrize(
    "name, scans",
    [
        # Counts without a station attribute read rides once and join nothing.
        ("daily_trend", 1),
        ("hourly_demand", 1),
        ("monthly_trend", 1),
        ("dataset_overview", 1),
        ("station_day_flow", 1),
        ("demand_features", 1),
        # Station reports count rides before the only join.
        ("imbalance_trend", 1),
        ("rebalancing_list", 1),
        ("station_daily_stats", 1),
    ],
)
def test_rides_are_scanned_once(spark, name, scans):
    text = plan(spark, name)
    assert text.count("events.parquet") == scans


@pytest.mark.parametrize("name", ["daily_trend", "hourly_demand", "monthly_trend", "station_day_flow"])
def test_no_join_without_station_attributes(spark, name):
    assert "Join" not in plan(spark, name)


def test_fact_with_a_small_daily_table_shuffles_no_rides(spark):
    text = plan(spark, "fact_rides")
    assert "SortMergeJoin" not in text
    rides_side = text[: text.index("events.parquet")]
    assert "Exchange hashpartitioning(hire_date" not in rides_side


def test_top_k_needs_no_global_sort(spark):
    for name in ("top_stations", "station_volume_top20", "top_imbalanced"):
        assert "TakeOrderedAndProject" in plan(spark, name)


def test_task_sizes_follow_the_bytes():
    tb = 1024**4
    small = sized_for(10 * MB, MB)
    assert small["spark.sql.shuffle.partitions"] == "200"
    assert small["spark.sql.files.maxPartitionBytes"] == str(16 * MB)
    large = sized_for(100 * tb, 40 * tb)
    assert large["spark.sql.files.maxPartitionBytes"] == str(256 * MB)
    assert int(large["spark.sql.shuffle.partitions"]) == 40 * tb // (256 * MB)
    assert large["spark.sql.adaptive.advisoryPartitionSizeInBytes"] == str(256 * MB)
