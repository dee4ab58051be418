"""Typed and filtered rides and stations."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockflow import constants as K
from dockflow.functions import calendar, stations


def stg_rides(raw: DataFrame) -> DataFrame:
    """Valid rides: known id, 60 to 86,400 seconds, end after start."""
    typed = raw.selectExpr(
        "CAST(rental_id AS BIGINT) AS rental_id",
        "CAST(bike_id AS BIGINT) AS bike_id",
        "CAST(start_station_id AS BIGINT) AS start_station_id",
        "start_station_name",
        "CAST(end_station_id AS BIGINT) AS end_station_id",
        "end_station_name",
        "CAST(start_date AS TIMESTAMP) AS start_datetime",
        "CAST(end_date AS TIMESTAMP) AS end_datetime",
        "CAST(duration AS BIGINT) AS duration_seconds",
    )
    valid = typed.filter(
        f"""rental_id IS NOT NULL AND end_datetime > start_datetime
            AND duration_seconds BETWEEN {K.MIN_RIDE_SECONDS} AND {K.MAX_RIDE_SECONDS}"""
    )
    start = F.col("start_datetime")
    return valid.select(
        *[c for c in typed.columns if c != "duration_seconds"],
        F.to_date(start).alias("hire_date"),
        calendar.start_hour(start).alias("start_hour"),
        calendar.day_of_week(start).alias("day_of_week"),
        calendar.is_weekend(start).alias("is_weekend"),
        "duration_seconds",
    )


def stg_stations(raw: DataFrame) -> DataFrame:
    """Stations inside the service area that have docks."""
    typed = raw.selectExpr(
        "CAST(id AS BIGINT) AS station_id",
        "name AS station_name",
        "terminal_name",
        "CAST(latitude AS DOUBLE) AS latitude",
        "CAST(longitude AS DOUBLE) AS longitude",
        "CAST(docks_count AS BIGINT) AS nb_docks",
        "CAST(installed AS BOOLEAN) AS is_installed",
        "CAST(locked AS BOOLEAN) AS is_locked",
        "CAST(temporary AS BOOLEAN) AS is_temporary",
        "CAST(install_date AS DATE) AS install_date",
    )
    valid = typed.filter(
        f"""station_id IS NOT NULL AND nb_docks > 0
            AND latitude BETWEEN {K.STATION_LAT[0]}D AND {K.STATION_LAT[1]}D
            AND longitude BETWEEN {K.STATION_LON[0]}D AND {K.STATION_LON[1]}D"""
    )
    return valid.select(
        "station_id",
        "station_name",
        "terminal_name",
        "latitude",
        "longitude",
        stations.zone_of("latitude", "longitude").alias("zone"),
        "nb_docks",
        "is_installed",
        "is_locked",
        "is_temporary",
        stations.capacity_tier(F.col("nb_docks")).alias("capacity_tier"),
        "install_date",
    )
