"""Ride-grain reports. Each needs one scan and one aggregation; none reads a station signal.

``rides`` is any ride-grain frame: the fact, the enriched rides or, cheapest, the banded rides.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockflow.functions.numeric import percent


def _rides() -> Column:
    return F.count(F.lit(1))


def _weekend() -> Column:
    return F.col("is_weekend").cast("bigint")


def between_dates(rides: DataFrame, date_from: str, date_to: str) -> DataFrame:
    """Both days included; prunes day directories of a stored fact."""
    return rides.filter(
        F.col("hire_date").between(F.lit(date_from).cast("date"), F.lit(date_to).cast("date"))
    )


def trailing_days(rides: DataFrame, as_of: str, days: int) -> DataFrame:
    return rides.filter(F.col("hire_date") >= F.date_sub(F.lit(as_of).cast("date"), days))


def daily_trend(rides: DataFrame, date_from: str, date_to: str) -> DataFrame:
    picked = between_dates(rides, date_from, date_to)
    return picked.groupBy("hire_date").agg(_rides().alias("rides")).orderBy("hire_date")


def calendar_rides(dim_date: DataFrame, rides: DataFrame) -> DataFrame:
    """Every day of the date dimension with its number of rides."""
    counted = rides.groupBy(F.col("hire_date").alias("full_date")).agg(_rides().alias("rides"))
    joined = dim_date.join(counted, "full_date", "left")
    return joined.select(*dim_date.columns, F.coalesce("rides", F.lit(0)).alias("rides"))


def hourly_demand(rides: DataFrame, date_from: str, date_to: str) -> DataFrame:
    picked = between_dates(rides, date_from, date_to)
    return picked.groupBy("start_hour").agg(_rides().alias("rides")).orderBy("start_hour")


def top_stations(rides: DataFrame, date_from: str, date_to: str, n: int = 10) -> DataFrame:
    counted = (
        between_dates(rides, date_from, date_to)
        .groupBy("start_station_name")
        .agg(_rides().alias("departures"))
    )
    return counted.orderBy(F.desc("departures"), "start_station_name").limit(n)


def hourly_demand_recent(rides: DataFrame, as_of: str, days: int = 30) -> DataFrame:
    return (
        trailing_days(rides, as_of, days)
        .groupBy("start_hour", "day_of_week", "is_weekend")
        .agg(_rides().alias("ride_count"), F.avg("duration_minutes").alias("avg_duration_mins"))
        .orderBy("start_hour", "day_of_week")
    )


def dataset_overview(rides: DataFrame) -> DataFrame:
    first, last = F.min("hire_date"), F.max("hire_date")
    return rides.agg(
        first.alias("earliest_ride"),
        last.alias("latest_ride"),
        (F.date_diff(last, first) + 1).cast("bigint").alias("days_covered"),
        _rides().alias("total_rides"),
        F.countDistinct("start_station_id").alias("unique_stations"),
        F.countDistinct("bike_id").alias("unique_bikes"),
        F.round(F.avg("duration_minutes"), 1).alias("avg_duration_mins"),
        F.sum(_weekend()).alias("weekend_rides"),
        F.sum("peak_hour_flag").alias("peak_hour_rides"),
    )


def monthly_trend(rides: DataFrame) -> DataFrame:
    return (
        rides.groupBy(F.trunc("hire_date", "MONTH").alias("month"))
        .agg(
            _rides().alias("ride_count"),
            F.round(F.avg("duration_minutes"), 1).alias("avg_duration"),
            percent(F.sum(_weekend()), _rides()).alias("pct_weekend"),
            percent(F.sum("peak_hour_flag"), _rides()).alias("pct_peak"),
        )
        .orderBy("month")
    )


def hourly_by_weekend(rides: DataFrame) -> DataFrame:
    return (
        rides.groupBy("start_hour", _weekend().alias("is_weekend"))
        .agg(
            _rides().alias("ride_count"),
            F.round(F.avg("duration_minutes"), 1).alias("avg_duration"),
        )
        .orderBy("is_weekend", "start_hour")
    )


def duration_filter(
    rides: DataFrame, date_from: str, date_to: str, low: float = 1, high: float = 120
) -> DataFrame:
    picked = between_dates(rides, date_from, date_to)
    return picked.filter(F.col("duration_minutes").between(low, high))


def duration_sample(rides: DataFrame, date_from: str, date_to: str) -> DataFrame:
    """Every ride of the window behind the distribution plots; ``explore.histogram`` is the small form."""
    return duration_filter(rides, date_from, date_to).select(
        "rental_id", "duration_minutes", "duration_band", "is_weekend", "peak_hour_flag"
    )


def category_counts(rides: DataFrame, column: str) -> DataFrame:
    """Rows per value, most frequent first."""
    return rides.groupBy(column).agg(_rides().alias("rides")).orderBy(F.desc("rides"), column)


def time_period_counts(rides: DataFrame, date_from: str, date_to: str) -> DataFrame:
    return category_counts(duration_filter(rides, date_from, date_to), "time_period")


def duration_band_counts(rides: DataFrame, date_from: str, date_to: str) -> DataFrame:
    return category_counts(duration_filter(rides, date_from, date_to), "duration_band")


def recent_rides(rides: DataFrame, as_of: str, days: int = 30) -> DataFrame:
    """All rides of the trailing days."""
    return trailing_days(rides, as_of, days)
