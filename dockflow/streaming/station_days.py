"""Departures per station and day as a stream with state, and their place beside the stored station-day table.

A day is open in the state store until the watermark has passed its end; then it is emitted once, in append mode, and its
state is dropped. Rides that come later than that are not counted by the stream: they are found by comparison with the
rides and mended by refreshing their days (``plans.refresh``).
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dockflow.plans.enrich import banded_rides
from dockflow.plans.staging import stg_rides
from dockflow.sources import sinks

KEYS = ["hire_date", "station_id", "station_name"]
PARTS = "hire_date date, station_id bigint, station_name string, peak bigint, rides bigint, minutes double"


def daily_departures(rides: DataFrame, delay: str = "7 days") -> DataFrame:
    """Counts of a stream of raw rides per day, station, name and peak flag; a day closes ``delay`` after its end.

    The peak flag is a key, so that the state holds one count and one sum, which the state reader can name.
    """
    banded = banded_rides(stg_rides(rides))
    counted = (
        banded.withWatermark("start_datetime", delay)
        .groupBy(F.window("start_datetime", "1 day"), "start_station_id", "start_station_name", "peak_hour_flag")
        .agg(F.count(F.lit(1)).alias("rides"), F.sum("duration_minutes").alias("minutes"))
    )
    return counted.select(
        F.to_date("window.start").alias("hire_date"),
        F.col("start_station_id").alias("station_id"),
        F.col("start_station_name").alias("station_name"),
        F.col("peak_hour_flag").cast("bigint").alias("peak"),
        "rides",
        "minutes",
    )


def count_available(rides: DataFrame, closed: str, checkpoint: str, delay: str = "7 days") -> None:
    """Count the rides that have arrived, append the days that have closed, then stop.

    Every batch has a directory of its own below ``closed``; a batch that is tried again replaces it.
    """

    def append(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{closed}/batch_id={batch_id}")

    query = (
        daily_departures(rides, delay)
        .writeStream.outputMode("append")
        .foreachBatch(append)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def open_days(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The days that have not closed, from the state store of the last committed batch."""
    state = spark.read.format("statestore").load(checkpoint)
    return state.select(
        F.to_date("key.window.start").alias("hire_date"),
        F.col("key.start_station_id").alias("station_id"),
        F.col("key.start_station_name").alias("station_name"),
        F.col("key.peak_hour_flag").cast("bigint").alias("peak"),
        F.col("value.count").alias("rides"),
        F.col("value.sum").alias("minutes"),
    )


def closed_days(spark: SparkSession, closed: str) -> DataFrame:
    if not sinks.matching(spark, f"{closed}/batch_id=*"):
        return spark.createDataFrame([], PARTS)
    return spark.read.schema(f"{PARTS}, batch_id bigint").parquet(closed).drop("batch_id")


def counted_days(spark: SparkSession, closed: str, checkpoint: str) -> DataFrame:
    """Departures of every station and day so far, and whether the day is closed."""
    parts = closed_days(spark, closed).withColumn("is_closed", F.lit(True))
    parts = parts.unionByName(open_days(spark, checkpoint).withColumn("is_closed", F.lit(False)))
    return parts.groupBy(*KEYS, "is_closed").agg(
        F.sum("rides").alias("total_departures"),
        F.sum(F.when(F.col("peak") == 1, F.col("rides")).otherwise(0)).alias("peak_departures"),
        F.sum("minutes").alias("sum_minutes"),
    )


def late_departures(rides: DataFrame, counted: DataFrame) -> DataFrame:
    """Station-days with rides that came after their day had closed, and how many: hire_date, station_id, late_rides."""
    due = (
        stg_rides(rides)
        .groupBy("hire_date", F.col("start_station_id").alias("station_id"))
        .agg(F.count(F.lit(1)).alias("rides"))
    )
    found = counted.groupBy("hire_date", "station_id").agg((-F.sum("total_departures")).alias("rides"))
    short = due.unionByName(found).groupBy("hire_date", "station_id").agg(F.sum("rides").alias("late_rides"))
    return short.filter("late_rides > 0")
