"""Hourly forecasts for every station: a row per station and hour of the day."""

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockflow import constants as K
from dockflow.functions.numeric import half_even, ratio
from dockflow.operators.features import trailing_demand, with_calendar


def station_hours(stations: DataFrame) -> DataFrame:
    """Every station 24 times."""
    hours = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(23).cast("bigint")))
    return stations.select("station_id", hours.alias("hour"))


def _banded(frame: DataFrame, predicted: Column) -> DataFrame:
    """Forecast with its planning buffer; all numbers to one decimal, never below zero."""
    rides = F.greatest(predicted, F.lit(0.0))
    buffer = rides * F.lit(K.BUFFER_SHARE)
    return frame.select(
        "station_id",
        "hour",
        half_even(rides, 1).alias("forecast"),
        half_even(rides - buffer, 1).alias("lower_ci"),
        half_even(rides + buffer, 1).alias("upper_ci"),
        F.col("hour").isin(*K.PEAK_HOURS).alias("is_peak"),
    )


def serving_features(stations: DataFrame, rides: DataFrame, day: str) -> DataFrame:
    """Features of the forecast day, with the real trailing demand of each station and hour."""
    grid = station_hours(stations).select(
        F.lit(day).cast("date").alias("hire_date"),
        F.col("station_id").alias("start_station_id"),
        "hour",
    )
    recent = trailing_demand(rides, day)
    joined = grid.join(recent, ["start_station_id", "hour"], "left")
    filled = joined.withColumn("rolling_7d_avg", F.coalesce("rolling_7d_avg", F.lit(0.0)))
    return with_calendar(filled).select("hire_date", *K.FEATURE_COLUMNS)


def forecast_all(
    model: PipelineModel, stations: DataFrame, rides: DataFrame, day: str
) -> DataFrame:
    scored = model.transform(serving_features(stations, rides, day))
    frame = scored.withColumn("station_id", F.col("start_station_id"))
    return _banded(frame, F.col("prediction"))


def fallback_forecast(stations: DataFrame, rides: DataFrame) -> DataFrame:
    """Forecast without a model: the daily profile scaled by the station's share of rides.

    The scale is the station's rides over the mean per active station, kept within 0.5 to 2.
    """
    volume = (
        rides.filter(F.col("start_station_id").isNotNull())
        .groupBy(F.col("start_station_id").alias("volume_id"))
        .agg(F.count(F.lit(1)).alias("volume"))
    )
    typical = volume.agg(F.avg("volume")).scalar()
    low, high = K.FALLBACK_SCALE
    share = ratio(F.coalesce("volume", F.lit(0)), typical)
    scaled = stations.join(volume, F.col("station_id") == F.col("volume_id"), "left").select(
        "station_id", F.least(F.greatest(share, F.lit(low)), F.lit(high)).alias("scale")
    )
    weights = F.array(*[F.lit(w) for w in K.HOUR_WEIGHTS])
    hours = scaled.select("station_id", "scale", F.posexplode(weights).alias("position", "weight"))
    hours = hours.withColumn("hour", F.col("position").cast("bigint"))
    return _banded(hours, F.col("weight") * F.col("scale") * F.lit(K.FALLBACK_RIDES))


def forecast_totals(forecast: DataFrame) -> DataFrame:
    """Day, peak and off-peak totals per station, and its next peak hour."""
    rides, peak = F.col("forecast"), F.col("is_peak")
    return forecast.groupBy("station_id").agg(
        F.sum(rides).alias("total_24h"),
        F.sum(F.when(peak, rides).otherwise(0.0)).alias("peak_total"),
        F.sum(F.when(~peak, rides).otherwise(0.0)).alias("offpeak_total"),
        F.min(F.when(peak, F.col("hour"))).alias("next_peak_hour"),
    )
