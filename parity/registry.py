"""One registered query per operator, on the given tables.

Doubles that no operator rounds are rounded to six digits here, because the order of a distributed
sum is not fixed. Thresholds are those that suit the given tables (FIXTURES.md section 4).
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dockflow import constants as K
from dockflow.operators import (
    boosting,
    explore,
    features,
    flow,
    forecast,
    models,
    planning,
    quality,
    schema_tests,
    segments,
    silhouette,
    stations,
    trends,
)
from dockflow.plans import marts, placed, refresh
from dockflow.plans.enrich import DAILY_COLUMNS, station_rolling
from dockflow.plans.warehouse import Warehouse
from dockflow.session import let_go
from dockflow.sources import increments, readers, schemas, sinks, testdata
from dockflow.streaming import incremental, station_days

DATE_FROM, DATE_TO = "2024-01-01", "2024-01-30"
AS_OF = "2024-01-31"
MIN_ROWS = 900
MIN_RIDES_REBALANCING, MIN_RIDES_SCENARIO, MIN_RIDES_HOTSPOT = 20, 10, 50
INCREMENT_AFTER, INCREMENT_UNTIL = "2024-01-15 00:00:00", "2024-01-22 12:00:00"
NOW_HOUR = 5
POINT = (51.50302, 0.02699)
# Centres for segments that no fit decides, in the units of the features.
CENTRES_4 = [(12, 0, 1, 1, 0, 0), (28, 1, 0, 0, 1, 0), (22, 0, 0, 0, 1, 0), (16, 0, 0, 0, 0, 1)]
CENTRES_3 = [(12, 8, 0, 1), (35, 13, 1, 0), (18, 15, 0, 0)]

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def _warehouse(spark: SparkSession, folder: str) -> Warehouse:
    w = Warehouse(testdata.cycle_hire(spark, folder), testdata.cycle_stations(spark, folder))
    w.folder = folder
    return w


def _register(name: str, build: Callable[[Warehouse], DataFrame], digits: dict[str, int] | None = None):
    def query(spark: SparkSession, folder: str) -> DataFrame:
        frame = build(_warehouse(spark, folder))
        rounded = {c: F.round(F.col(c), n) for c, n in (digits or {}).items()}
        return frame.withColumns(rounded) if rounded else frame

    QUERIES[name] = query


def _six(*columns: str) -> dict[str, int]:
    return dict.fromkeys(columns, 6)


DATES = (DATE_FROM, DATE_TO)


def _stored(w: Warehouse) -> Warehouse:
    """For queries that read the fact: the daily flow is counted once and stored."""
    return w.with_stored_daily(sinks.fresh_path(w.spark, "station-days"))


def _scenario(w: Warehouse) -> DataFrame:
    return stations.scenario_list(w.station_day_rides, *DATES, MIN_RIDES_SCENARIO)


def _rebalancing(w: Warehouse) -> DataFrame:
    return stations.rebalancing_list(w.station_day_rides, *DATES, MIN_RIDES_REBALANCING)


def _hotspots(w: Warehouse) -> DataFrame:
    return stations.hotspot_profile(w.station_day_rides, MIN_RIDES_HOTSPOT)


def _flow(w: Warehouse) -> DataFrame:
    return flow.station_flow(w.raw_rides, w.raw_stations)


def _day_flow(w: Warehouse) -> DataFrame:
    return flow.station_day_flow(w.raw_rides)


# --- warehouse tables ---
_register("stg_rides", lambda w: w.stg_rides)
_register("stg_stations", lambda w: w.stg_stations)
_register("rides_enriched", lambda w: w.rides_enriched)
DAILY_DIGITS = _six("avg_duration_mins", "utilisation_rate", "imbalance_score")
_register("station_daily_stats", lambda w: w.station_daily, DAILY_DIGITS)
_register(
    "station_rolling",
    lambda w: station_rolling(w.station_daily).select(
        "hire_date", "station_id", "total_departures", "rolling_7d_avg_departures"
    ),
    _six("rolling_7d_avg_departures"),
)
_register("dim_date", lambda w: trends.calendar_rides(w.dim_date, w.banded_rides))
_register(
    "dim_stations", lambda w: w.dim_stations, _six("avg_imbalance_score_7d", "avg_utilisation_rate_7d")
)
FACT_DIGITS = _six(
    "start_station_imbalance_score", "start_station_utilisation_rate", "start_station_rolling_7d_avg"
)
_register("fact_rides", lambda w: _stored(w).fact_rides, FACT_DIGITS)

# --- mart reports ---
_register("kpi_summary", lambda w: stations.kpi_summary(w.station_day_rides, *DATES))
_register("daily_trend", lambda w: trends.daily_trend(w.banded_rides, *DATES))
_register("hourly_demand", lambda w: trends.hourly_demand(w.banded_rides, *DATES))
_register("top_stations", lambda w: trends.top_stations(w.banded_rides, *DATES))
_register("imbalanced_station_days", lambda w: flow.imbalanced_station_days(_day_flow(w)), _six("imbalanced_pct"))
_register(
    "station_imbalance_recent",
    lambda w: stations.station_imbalance_recent(w.station_day_rides, AS_OF),
    _six("avg_imbalance_score"),
)
_register(
    "hourly_demand_recent",
    lambda w: trends.hourly_demand_recent(w.banded_rides, AS_OF),
    {"avg_duration_mins": 8},
)
_register("rebalancing_list", _rebalancing)
_register("scenario_list", _scenario)
_register("hotspot_profile", _hotspots, _six("pct_days_draining", "pct_days_imbalanced"))
_register("dataset_overview", lambda w: trends.dataset_overview(w.banded_rides))
_register("monthly_trend", lambda w: trends.monthly_trend(w.banded_rides), _six("pct_weekend", "pct_peak"))
_register("hourly_by_weekend", lambda w: trends.hourly_by_weekend(w.banded_rides))
_register("station_volume_top20", lambda w: stations.station_volume(w.station_day_rides), _six("pct_peak_rides"))
_register(
    "imbalance_trend", lambda w: stations.imbalance_trend(w.station_day_rides), _six("pct_rides_imbalanced")
)
_register("trend_extremes", lambda w: stations.trend_extremes(w.station_day_rides, w.banded_rides), _six("value"))
_register("time_period_counts", lambda w: trends.time_period_counts(w.banded_rides, *DATES))
_register("duration_band_counts", lambda w: trends.duration_band_counts(w.banded_rides, *DATES))
_register("draining_filling_top10", lambda w: stations.draining_filling_top(_hotspots(w)))
_register("duration_sample", lambda w: trends.duration_sample(w.banded_rides, *DATES))
_register("recent_rides", lambda w: trends.recent_rides(_stored(w).fact_rides, AS_OF), FACT_DIGITS)

# --- flow on raw rides ---
_register("station_flow", _flow, _six("imb_score"))
_register("station_day_flow", _day_flow, _six("imb_score"))
_register("station_flow_map", lambda w: flow.station_flow_map(w.raw_rides, w.raw_stations), _six("imb_score"))
_register("station_flow_list", lambda w: flow.station_flow_list(w.raw_rides, w.raw_stations), _six("imb_score"))
_register("period_flow", lambda w: flow.period_flow(w.raw_rides))
_register("period_hotspots", lambda w: flow.period_hotspots(flow.period_flow(w.raw_rides), w.raw_stations))
_register("priority_counts", lambda w: flow.priority_counts(_flow(w)))
_register("zone_imbalance", lambda w: flow.zone_imbalance(_flow(w)))
_register("network_daily_imbalance", lambda w: flow.network_daily_imbalance(_day_flow(w)), _six("imb_score"))
_register("network_mean_imbalance", lambda w: flow.network_mean_imbalance(_day_flow(w)), _six("mean_imb_score"))
_register("top_imbalanced", lambda w: flow.top_imbalanced(_flow(w)), _six("imb_score"))

# --- exploration of raw rides ---
SUMMARY_DIGITS = _six(
    "avg_minutes", "median_minutes", "min_minutes", "max_minutes", "total_hours", "peak_pct", "weekend_pct"
)
_register("ride_summary", lambda w: explore.ride_summary(w.explored), SUMMARY_DIGITS)
_register("eda_duration_bands", lambda w: explore.duration_bands(w.explored), _six("pct"))
_register("hourly_profile_pct", lambda w: explore.hourly_profile(w.explored, "is_weekend"), _six("pct"))
_register("dow_counts", lambda w: explore.dow_counts(w.explored))
_register("month_counts", lambda w: explore.month_counts(w.explored))
_register("dow_hour_pivot", lambda w: explore.dow_hour_pivot(w.explored))
_register(
    "peak_offpeak",
    lambda w: explore.peak_offpeak(w.explored),
    _six(
        "peak_pct",
        "offpeak_pct",
        "peak_ratio",
        "weekday_rides_per_day",
        "weekend_rides_per_day",
        "weekend_extra_minutes",
    ),
)
_register("duration_histogram", lambda w: explore.duration_histogram(w.explored), _six("bin_low", "density"))
_register("flow_histogram", lambda w: explore.flow_histogram(_flow(w)), _six("bin_low", "density"))
_register("key_findings", lambda w: explore.key_findings(w.explored, _flow(w)), _six("value"))
_register("profile_rides", lambda w: explore.column_profile(w.raw_rides))
_register("profile_stations", lambda w: explore.column_profile(w.raw_stations))
_register("rider_features", lambda w: segments.rider_features(w.explored), _six("duration_minutes"))
_register("rule_segments", lambda w: segments.rule_segments(w.banded_rides), _six("pct"))

# --- data quality ---
_register("quality_post_ingest", lambda w: quality.post_ingest(w.raw_rides, w.raw_stations, MIN_ROWS), _six("value"))


def _stored_fact(w: Warehouse) -> tuple[Warehouse, DataFrame]:
    """The warehouse with its daily flow stored, and the fact written once and read back, as it is published."""
    s = _stored(w)
    path = placed.write_placed_fact(s.placed_fact, sinks.fresh_path(w.spark, "fact"))
    return s, sinks.read_fact(w.spark, path, marts.FACT_COLUMNS)


def _post_transform(w: Warehouse) -> DataFrame:
    s, fact = _stored_fact(w)
    return quality.post_transform(fact, s.dim_stations, s.dim_date, MIN_ROWS)


_register("quality_post_transform", _post_transform, _six("value"))
_register("quality_files", lambda w: quality.delivered_files(w.raw_rides, w.raw_stations), _six("value"))


def _staging_tests(w: Warehouse) -> DataFrame:
    tables = {
        "cycle_hire": w.raw_rides,
        "cycle_stations": w.raw_stations,
        "stg_cycle_hire": w.stg_rides,
        "stg_cycle_stations": w.stg_stations,
    }
    return schema_tests.run_schema_tests(schema_tests.STAGING_TESTS, tables)


def _mart_tests(w: Warehouse) -> DataFrame:
    s, fact = _stored_fact(w)
    tables = {"fact_rides": fact, "dim_stations": s.dim_stations, "dim_date": s.dim_date}
    return schema_tests.run_schema_tests(schema_tests.MART_TESTS, tables)


_register("schema_tests_staging", _staging_tests)
_register("schema_tests_marts", _mart_tests)
_register("assert_ride_duration", lambda w: schema_tests.rides_ending_before_start(w.banded_rides))


def _raw_as_typed(w: Warehouse) -> DataFrame:
    names = {"start_date": "start_datetime", "end_date": "end_datetime", "duration": "duration_seconds"}
    return w.raw_rides.withColumnsRenamed(names)


_register("assert_raw_duration", lambda w: schema_tests.rides_ending_before_start(_raw_as_typed(w)))
_register(
    "fk_orphans",
    lambda w: quality.orphan_keys(w.banded_rides, "start_station_id", w.stg_stations, "station_id"),
)

# --- planning ---
_register("dispatch_list", lambda w: planning.dispatch_list(_scenario(w)))
_register("danger_zone", lambda w: planning.danger_zone(_scenario(w)))
_register("station_at_point", lambda w: planning.station_at_point(_scenario(w), *POINT))
STATION_MAP_DIGITS = _six("imb_score", "radius")
_register("station_map", lambda w: planning.station_map(w.dim_stations), STATION_MAP_DIGITS)
_register(
    "station_map_filtered",
    lambda w: planning.filter_map(planning.station_map(w.dim_stations), planning.URGENT, ["draining", "filling"]),
    STATION_MAP_DIGITS,
)
_register("map_summary", lambda w: planning.map_summary(planning.station_map(w.dim_stations)))
_register(
    "map_centre",
    lambda w: planning.map_centre(planning.danger_zone(_scenario(w))),
    _six("centre_lat", "centre_lon"),
)
_register("crew_plan", lambda w: planning.crew_plan(_rebalancing(w), _scenario(w)))
_register("action_statement", lambda w: planning.action_statement(_scenario(w)))
_register("dispatch_recommendation", lambda w: planning.dispatch_recommendation(_scenario(w), NOW_HOUR))
_register("forecast_fallback", lambda w: forecast.fallback_forecast(w.stg_stations, w.banded_rides))
_register(
    "forecast_fallback_totals",
    lambda w: forecast.forecast_totals(forecast.fallback_forecast(w.stg_stations, w.banded_rides)),
    _six("total_24h", "peak_total", "offpeak_total"),
)

# --- demand features ---
_register("demand_features", lambda w: features.demand_features(w.banded_rides), _six("rolling_7d_avg"))
_register("trailing_demand", lambda w: features.trailing_demand(w.banded_rides, AS_OF), _six("rolling_7d_avg"))

# --- sources ---
_register("extract_stations", lambda w: readers.extract(w.raw_stations, schemas.STATIONS.fieldNames()))
_register(
    "incremental_extract",
    lambda w: readers.incremental(
        w.raw_rides,
        "start_date",
        F.lit(INCREMENT_AFTER).cast("timestamp"),
        F.lit(INCREMENT_UNTIL).cast("timestamp"),
    ),
)


def text_feed(w: Warehouse) -> DataFrame:
    """Rides as an all-text delivery in which a lost bike has the end station 'unknown'."""
    text = readers.as_text(w.raw_rides)
    return text.withColumn("end_station_id", F.coalesce("end_station_id", F.lit("unknown")))


def _rejected(w: Warehouse) -> DataFrame:
    validated = readers.validate_records(text_feed(w), schemas.RIDES)
    return readers.rejected_records(validated, schemas.RIDES).select(
        "rental_id", "duration", "bike_id", "end_station_id", "start_station_id", "rejected_for"
    )


_register("rejected_records", _rejected)

# --- sinks: each writes, then returns what it reads back ---


def _path(w: Warehouse, name: str) -> str:
    return sinks.fresh_path(w.spark, name)


def _csv_roundtrip(w: Warehouse) -> DataFrame:
    return readers.read_rides_csv(w.spark, sinks.write_csv(w.raw_rides, _path(w, "rides-csv")))


def _load_raw(w: Warehouse) -> DataFrame:
    stored = w.spark.read.parquet(sinks.load_raw(w.raw_rides, schemas.RIDES, _path(w, "raw-rides")))
    received = F.col("_sdc_received_at").isNotNull() & F.col("_sdc_sequence").isNotNull()
    return stored.select(*schemas.RIDES.fieldNames(), "_sdc_table_version", received.alias("has_receipt"))


def _write_fact(w: Warehouse) -> DataFrame:
    return _stored_fact(w)[1]


def _write_dims(w: Warehouse) -> DataFrame:
    """Both dimensions read back: every station, and every day under its number and name."""
    stations, days = (
        w.spark.read.parquet(sinks.write_table(t, _path(w, n)))
        for n, t in (("dim_stations", w.dim_stations), ("dim_date", w.dim_date))
    )
    named = days.select(F.lit("dim_date").alias("table_name"), "date_id", F.col("day_name").alias("name"), F.col("season").alias("kind"))
    return named.union(stations.select(F.lit("dim_stations"), "station_id", "station_name", "rebalancing_priority"))


def _export_dispatch(w: Warehouse) -> DataFrame:
    listed = planning.dispatch_list(_rebalancing(w))
    path = sinks.write_csv(listed, _path(w, "dispatch"))
    return readers.read_csv(w.spark, path, listed.schema)


def _quality_report(w: Warehouse) -> DataFrame:
    results = quality.post_ingest(w.raw_rides, w.raw_stations, MIN_ROWS)
    path = quality.save_results(results, _path(w, "checks"))
    return quality.status_counts(quality.read_results(w.spark, path))


def _schema_presence(w: Warehouse) -> DataFrame:
    return readers.schema_presence({"cycle_hire": w.raw_rides, "cycle_stations": w.raw_stations})


_register("csv_roundtrip", _csv_roundtrip)
_register("load_raw", _load_raw)
_register("write_fact", _write_fact, FACT_DIGITS)
_register("write_dims", _write_dims)
_register("export_dispatch", _export_dispatch)
_register("fact_schema", lambda w: readers.column_listing(_stored_fact(w)[1]))
_register("schema_presence", _schema_presence)
_register("quality_report", _quality_report)


def _stream(w: Warehouse) -> DataFrame:
    source = sinks.write_table(w.raw_rides, _path(w, "stream-source"))
    target, state = _path(w, "stream-target"), _path(w, "stream-state")
    incremental.load_available(incremental.ride_stream(w.spark, source), target, state, **INDEX_SIZES)
    return incremental.loaded(w.spark, target)


_register("stream_incremental", _stream)
INDEX_SIZES = {"buckets": 16, "cells": 1024}  # of a hundred thousand rides


def _timestamp(text: str):
    return F.lit(text).cast("timestamp")


def _bookmarked(w: Warehouse) -> str:
    """Three runs of one bookmarked load; each extracts its bookmark's moment again."""
    target = _path(w, "bookmarked")
    for until in (_timestamp(INCREMENT_AFTER), _timestamp(INCREMENT_UNTIL), None):
        increments.load_increment(w.raw_rides, target, "daily", until=until, **INDEX_SIZES)
    return target


_register(
    "bookmark_loads",
    lambda w: increments.stored_rides(w.spark, _bookmarked(w)).select(*schemas.RIDES.fieldNames(), "batch_id"),
)
_register("load_history", lambda w: increments.load_history(w.spark, _bookmarked(w)))


def _station_day_stream(w: Warehouse) -> DataFrame:
    """Three deliveries of rides, in order of their days; each is counted as it comes."""
    source, closed, state = (_path(w, f"station-days-{n}") for n in ("source", "closed", "state"))
    start = F.col("start_date")
    after, until = _timestamp(INCREMENT_AFTER), _timestamp(INCREMENT_UNTIL)
    for delivery in (start <= after, (start > after) & (start <= until), start > until):
        w.raw_rides.filter(delivery).write.mode("append").parquet(source)
        station_days.count_available(incremental.ride_stream(w.spark, source), closed, state)
    return station_days.counted_days(w.spark, closed, state)


_register("stream_station_days", _station_day_stream, _six("sum_minutes"))


def _refreshed(w: Warehouse) -> DataFrame:
    """The stored station-day table after a late load of a week in the middle; only what it changes is counted again."""
    target, daily = _path(w, "rides"), _path(w, "station-days")
    start = F.col("start_date")
    late = (start > _timestamp(INCREMENT_AFTER)) & (start <= _timestamp(INCREMENT_UNTIL))
    increments.append_batch(w.raw_rides.filter(~late), target, "daily", 0, **INDEX_SIZES)
    refresh.build_station_days(increments.stored_rides(w.spark, target), w.stg_stations, daily)
    increments.append_batch(w.raw_rides.filter(late), target, "daily", 1, **INDEX_SIZES)
    rides = increments.stored_rides(w.spark, target)
    days = refresh.touched_days(rides.filter("batch_id = 1"))
    refresh.refresh_station_days(rides, w.stg_stations, daily, days)
    return refresh.read_station_days(w.spark, daily).select(*DAILY_COLUMNS, refresh.ROLLING)


_register("refreshed_station_days", _refreshed, {**DAILY_DIGITS, **_six("rolling_7d_avg_departures")})

# --- models and segments ---


TRAINED: dict[tuple[str, str], tuple] = {}


def _trained(w: Warehouse) -> tuple:
    """Importances of all models fitted with the settings of the full run, their ranking, and the folder of the winner.

    Trained once per application and folder of tables; the queries below are its table, its importances and forecasts.
    """
    key = (w.spark.sparkContext.applicationId, w.folder)
    if key not in TRAINED:
        fitted, ranked, best = models.train(features.demand_features(w.banded_rides))
        path = models.save_model(fitted[best], _path(w, "demand-model"))
        TRAINED[key] = models.feature_importance(fitted, w.spark), ranked, path
        # The driver keeps no model: the trees of a forest take a good part of its memory, and one is loaded next.
        del fitted
        let_go(w.spark)
    return TRAINED[key]


def _train_compare(w: Warehouse) -> DataFrame:
    return _trained(w)[1]


def _importance(w: Warehouse) -> DataFrame:
    return _trained(w)[0]


def _forecast(w: Warehouse) -> DataFrame:
    """The forecast of the model that won by RMSE, loaded from where training has saved it."""
    best = models.load_model(_trained(w)[2])
    return forecast.forecast_all(best, w.stg_stations, w.banded_rides, AS_OF)


def _rider_points(w: Warehouse) -> DataFrame:
    return segments.weighted_points(segments.rider_features(w.explored), segments.RIDER_SPEC)


def _mart_points(w: Warehouse) -> DataFrame:
    rides = trends.duration_filter(w.banded_rides, *DATES)
    return segments.weighted_points(rides, segments.MART_SPEC)


def _profile(points: DataFrame, spec: segments.SegmentSpec) -> DataFrame:
    return segments.profile(segments.assign(points, spec), spec)


def _labelled(points: DataFrame, spec: segments.SegmentSpec) -> DataFrame:
    assigned = segments.assign(points, spec)
    return segments.label_points(assigned, segments.profile(assigned, spec))


def _segment_durations(w: Warehouse) -> DataFrame:
    labelled = _labelled(_rider_points(w), segments.RIDER_SPEC)
    return segments.durations_by_segment(labelled, K.SEGMENTS_4)


# Fewer and larger steps than a full run, which takes ten times as long.
FEW_ROUNDS = boosting.BoostSettings(rounds=30, step=0.1)


_register("train_compare", _train_compare)
_register(
    "boosted_scores",
    lambda w: models.second_order(features.demand_features(w.banded_rides), FEW_ROUNDS)[1],
    _six("rmse", "mae", "r2"),
)
_register("feature_importance", _importance)
_register("forecast_all", _forecast)
_register("forecast_totals", lambda w: forecast.forecast_totals(_forecast(w)))
_register("kmeans_scan", lambda w: segments.scan_k(_rider_points(w), segments.RIDER_SPEC))
_register("segment_profile_k4", lambda w: _profile(_rider_points(w), segments.RIDER_SPEC))
_register("segment_profile_k3", lambda w: _profile(_mart_points(w), segments.MART_SPEC))
_register(
    "segment_hours_k3", lambda w: segments.hourly_by_segment(_labelled(_mart_points(w), segments.MART_SPEC))
)
_register("segment_durations_k4", _segment_durations)
_register(
    "segment_weekend_k4",
    lambda w: segments.weekend_share_by_segment(_labelled(_rider_points(w), segments.RIDER_SPEC)),
)


def _given(points: DataFrame, spec: segments.SegmentSpec, centres: list) -> tuple[DataFrame, DataFrame]:
    """Points labelled by given centres, and the profile of these segments."""
    assigned = segments.assign_to(points, spec, centres)
    found = segments.profile(assigned, spec)
    return segments.label_points(assigned, found), found


def _given_4(w: Warehouse) -> tuple[DataFrame, DataFrame]:
    return _given(_rider_points(w), segments.RIDER_SPEC, CENTRES_4)


def _given_3(w: Warehouse) -> tuple[DataFrame, DataFrame]:
    return _given(_mart_points(w), segments.MART_SPEC, CENTRES_3)


_register("given_profile_k4", lambda w: _given_4(w)[1])
_register(
    "given_silhouette_k4",
    lambda w: silhouette.cluster_silhouettes(
        silhouette.point_silhouettes(
            segments.assign_to(_rider_points(w), segments.RIDER_SPEC, CENTRES_4), segments.RIDER_SPEC
        )
    ),
    _six("silhouette", "silhouette_all"),
)
_register("given_profile_k3", lambda w: _given_3(w)[1])
_register("given_hours_k3", lambda w: segments.hourly_by_segment(_given_3(w)[0]), _six("pct"))
_register(
    "given_durations_k3",
    lambda w: segments.durations_by_segment(_given_3(w)[0], K.SEGMENTS_3, clip_at=None, bins=40),
    _six("bin_low", "density"),
)
_register("given_weekend_k4", lambda w: segments.weekend_share_by_segment(_given_4(w)[0]), _six("weekend_pct"))
_register(
    "key_findings_commuters",
    lambda w: explore.key_findings(w.explored, _flow(w), _given_4(w)[0]),
    _six("value"),
)
_register("mart_durations", lambda w: explore.mart_durations(trends.duration_filter(w.banded_rides, *DATES)), _six("bin_low", "median", "mean"))
_register(
    "demand_split",
    lambda w: quality.union_all(
        [
            part.select(*models.SPLIT_KEYS, F.lit(i == 0).alias("trains"))
            for i, part in enumerate(models.split(features.demand_features(w.banded_rides)))
        ]
    ),
)
_register("baseline_scores", lambda w: models.baseline_scores(features.demand_features(w.banded_rides)), _six("rmse", "mae", "r2"))
_register(
    "serving_features",
    lambda w: forecast.serving_features(w.stg_stations, w.banded_rides, AS_OF),
    _six("rolling_7d_avg"),
)
_register("training_extract", lambda w: features.training_extract(_stored_fact(w)[1], "2024-01-05", "2024-01-25"))
_register("high_water_mark", lambda w: readers.high_water_mark(w.raw_rides, "start_date"))
_register("accepted_records", lambda w: readers.accepted_records(readers.validate_records(text_feed(w), schemas.RIDES), schemas.RIDES))
_register("segment_points_k4", _rider_points, _six("duration_minutes"))
_register("segment_points_k3", _mart_points)
