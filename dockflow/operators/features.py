"""Demand features: rides per station, day and hour with a leak-free trailing mean."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dockflow import constants as K
from dockflow.functions import calendar


def hourly_rides(rides: DataFrame) -> DataFrame:
    """Rides per (day, station, hour); the calendar features follow from the day."""
    return (
        rides.filter(F.col("start_station_id").isNotNull())
        .groupBy("hire_date", "start_station_id", F.col("start_hour").alias("hour"))
        .agg(F.count(F.lit(1)).alias(K.LABEL_COLUMN))
    )


def with_calendar(hours: DataFrame) -> DataFrame:
    day = F.col("hire_date")
    return hours.withColumns(
        {
            "day_of_week": calendar.day_of_week(day),
            "is_weekend": calendar.is_weekend(day).cast("bigint"),
            "is_holiday": calendar.is_ml_holiday(day),
            "season": calendar.season_code(day),
        }
    )


def demand_features(rides: DataFrame) -> DataFrame:
    """Seven features and the label, keyed by day, station and hour.

    ``rolling_7d_avg`` is the mean of the up to seven earlier rows of the same station and hour, so
    a row never sees its own label; the first row has 0.
    """
    earlier = (
        Window.partitionBy("start_station_id", "hour")
        .orderBy("hire_date")
        .rowsBetween(-K.ROLLING_ROWS, -1)
    )
    rolling = F.coalesce(F.avg(K.LABEL_COLUMN).over(earlier), F.lit(0.0))
    features = with_calendar(hourly_rides(rides).withColumn("rolling_7d_avg", rolling))
    return features.select("hire_date", *K.FEATURE_COLUMNS, K.LABEL_COLUMN)


TRAINING_COLUMNS = [
    "rental_id", "start_datetime", "duration_seconds", "start_station_id", "hire_date", "start_hour",
    "day_of_week", "is_weekend", "peak_hour_flag",
]


def training_extract(fact: DataFrame, date_from: str, date_to: str) -> DataFrame:
    """The columns of the fact that training needs, of one range of days; a stored fact is pruned to both."""
    days = F.col("hire_date").between(F.lit(date_from).cast("date"), F.lit(date_to).cast("date"))
    return fact.filter(days).select(*TRAINING_COLUMNS)


def trailing_demand(rides: DataFrame, as_of: str) -> DataFrame:
    """Mean of the last seven active days before ``as_of`` per station and hour: the serving value."""
    past = hourly_rides(rides.filter(F.col("hire_date") < F.lit(as_of).cast("date")))
    newest = Window.partitionBy("start_station_id", "hour").orderBy(F.desc("hire_date"))
    return (
        past.withColumn("age", F.row_number().over(newest))
        .filter(F.col("age") <= K.ROLLING_ROWS)
        .groupBy("start_station_id", "hour")
        .agg(F.avg(K.LABEL_COLUMN).alias("rolling_7d_avg"))
    )
