"""Dimensions and the ride fact."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dockflow import constants as K
from dockflow.functions import calendar, rides as R, stations as S
from dockflow.plans.enrich import SIGNALS, station_rolling

FACT_COLUMNS = [
    "ride_sk",
    "rental_id",
    "bike_id",
    "hire_date",
    "start_datetime",
    "end_datetime",
    "start_hour",
    "day_of_week",
    "is_weekend",
    "time_period",
    "peak_hour_flag",
    "duration_seconds",
    "duration_minutes",
    "duration_band",
    "start_station_id",
    "start_station_name",
    "start_zone",
    "start_nb_docks",
    "start_capacity_tier",
    "start_lat",
    "start_lon",
    "end_station_id",
    "end_station_name",
    "end_zone",
    "end_nb_docks",
    "end_capacity_tier",
    "end_lat",
    "end_lon",
    "is_round_trip",
    *[out for out, _ in SIGNALS.values()],
]


def date_spine(spark: SparkSession, start: str, end: str) -> DataFrame:
    """One row per day from ``start`` up to but excluding ``end``."""
    first, stop = F.lit(start).cast("date"), F.lit(end).cast("date")
    days = F.sequence(first, F.date_sub(stop, 1))
    return spark.range(1).select(F.explode(days).alias("date_day"))


def dim_date(spark: SparkSession, start: str = K.SPINE_START, end: str = K.SPINE_END) -> DataFrame:
    day = F.col("date_day")
    holiday = calendar.mart_holiday_name(day)
    return date_spine(spark, start, end).select(
        F.date_format(day, "yyyyMMdd").cast("bigint").alias("date_id"),
        day.alias("full_date"),
        F.year(day).cast("bigint").alias("year"),
        F.quarter(day).cast("bigint").alias("quarter"),
        F.month(day).cast("bigint").alias("month"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.date_format(day, "MMM").alias("month_abbr"),
        calendar.week_number(day).alias("week_number"),
        calendar.day_of_week(day).alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
        F.date_format(day, "EEE").alias("day_abbr"),
        calendar.is_weekend(day).alias("is_weekend"),
        holiday.isNotNull().alias("is_uk_bank_holiday"),
        holiday.alias("bank_holiday_name"),
        calendar.season_name(day).alias("season"),
    )


def dim_stations(stations: DataFrame, daily: DataFrame) -> DataFrame:
    """Stations with their all-time flow. The "7d" averages cover all days, as the name does not say."""
    history = daily.groupBy(F.col("station_id").alias("history_id")).agg(
        F.avg("imbalance_score").alias("score"),
        F.avg("utilisation_rate").alias("utilisation"),
        F.sum("total_departures").alias("departures"),
        F.sum("total_arrivals").alias("arrivals"),
        F.max("hire_date").alias("last_activity_date"),
    )
    joined = stations.join(history, stations.station_id == history.history_id, "left")
    score = F.coalesce(F.col("score"), F.lit(0.0))
    return joined.select(
        R.surrogate_key(F.col("station_id")).alias("station_sk"),
        "station_id",
        "station_name",
        "terminal_name",
        "latitude",
        "longitude",
        "zone",
        "nb_docks",
        "capacity_tier",
        "is_installed",
        "is_locked",
        "is_temporary",
        "install_date",
        score.alias("avg_imbalance_score_7d"),
        F.coalesce(F.col("utilisation"), F.lit(0.0)).alias("avg_utilisation_rate_7d"),
        F.coalesce(F.col("departures"), F.lit(0)).alias("total_departures_all_time"),
        F.coalesce(F.col("arrivals"), F.lit(0)).alias("total_arrivals_all_time"),
        "last_activity_date",
        S.priority(score, "mart").alias("rebalancing_priority"),
    )


def fact_rides(enriched: DataFrame, daily: DataFrame) -> DataFrame:
    """One row per ride with the signals of its start station on that day.

    Read from a stored daily table, the signals are broadcast if Spark finds their bytes below its threshold; rides are
    not shuffled then. Otherwise both sides are shuffled by day and station, and adaptive execution splits a
    station-day that overloads its partition.
    """
    signals = station_rolling(daily).select(
        F.col("hire_date").alias("signal_date"), F.col("station_id").alias("signal_station"), *SIGNALS
    )
    same_station_day = (enriched.hire_date == signals.signal_date) & (
        enriched.start_station_id == signals.signal_station
    )
    defaults = {
        out: F.coalesce(F.col(name), F.lit(default)) for name, (out, default) in SIGNALS.items()
    }
    return (
        enriched.join(signals, same_station_day, "left")
        .withColumns({"ride_sk": R.surrogate_key(F.col("rental_id")), **defaults})
        .select(*FACT_COLUMNS)
    )
