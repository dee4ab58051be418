"""Keeping the stored station-day table up to date without counting all rides again.

The table lies by day. After a load only the days with new rides are counted again, from their directories of rides. A
changed day moves the rolling means of the station's following active days; these are recomputed from the narrow stored
counts of the stations concerned. Days with a changed row are then overwritten, all others stay as they are.
"""

from datetime import date

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dockflow.plans.enrich import banded_rides, station_daily_stats, station_rolling
from dockflow.plans.staging import stg_rides
from dockflow.sources import sinks

KEYS = ["hire_date", "station_id", "station_name"]
ROLLING = "rolling_7d_avg_departures"


def _write(table: DataFrame, path: str) -> None:
    (
        table.repartition("hire_date")
        .sortWithinPartitions("hire_date", "station_id")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("hire_date")
        .parquet(path)
    )


def build_station_days(rides: DataFrame, stations: DataFrame, path: str) -> None:
    """Count all stored rides (raw columns with ``hire_date``) and store every station-day with its rolling mean."""
    daily = station_daily_stats(banded_rides(stg_rides(rides)), stations)
    sinks.remove(rides.sparkSession, path)
    _write(station_rolling(daily), path)


def read_station_days(spark: SparkSession, path: str) -> DataFrame:
    found = spark.read.parquet(path)
    return found.select("hire_date", *[c for c in found.columns if c != "hire_date"])


def touched_days(rides: DataFrame) -> list[date]:
    """The days of these rides: at most the days of the calendar reach the driver."""
    return sorted(r[0] for r in rides.select("hire_date").distinct().collect())


def _same(a: str, b: str):
    return F.col(a).eqNullSafe(F.col(b))


def refreshed_rows(rides: DataFrame, stations: DataFrame, stored: DataFrame, days: list[date]) -> DataFrame:
    """The new rows of every day that changes when ``days`` are counted again.

    ``rides`` are all stored rides by ``hire_date``: only the directories of ``days`` are read. ``is_changed`` tells the
    rows whose counts or rolling mean are new from those that share their day.
    """
    counted = station_daily_stats(banded_rides(stg_rides(rides.filter(F.col("hire_date").isin(days)))), stations)
    others = stored.filter(~F.col("hire_date").isin(days))
    narrow = [*KEYS, "total_departures"]
    concerned = (
        counted.select("station_id")
        .union(stored.filter(F.col("hire_date").isin(days)).select("station_id"))
        .distinct()
        .withColumnRenamed("station_id", "concerned_id")
    )
    history = others.select(*narrow, ROLLING, F.lit(False).alias("recounted")).unionByName(
        counted.select(*narrow, F.lit(None).cast("double").alias(ROLLING), F.lit(True).alias("recounted"))
    )
    history = history.join(concerned, _same("station_id", "concerned_id"), "left_semi")
    last_rows = Window.partitionBy("station_id").orderBy("hire_date", "station_name").rowsBetween(-6, 0)
    moved = (
        history.withColumn("rolling", F.avg("total_departures").over(last_rows))
        .filter(F.col("recounted") | ~_same("rolling", ROLLING))
        .select(*[F.col(k).alias(f"moved_{k}") for k in KEYS], "rolling", F.lit(True).alias("is_changed"))
    )
    rows = others.unionByName(counted.withColumn(ROLLING, F.lit(None).cast("double")))
    same_row = [_same(k, f"moved_{k}") for k in KEYS]
    marked = rows.join(moved, same_row, "left").withColumns(
        {ROLLING: F.coalesce("rolling", ROLLING), "is_changed": F.coalesce("is_changed", F.lit(False))}
    )
    whole_day = marked.withColumn("day_changed", F.max("is_changed").over(Window.partitionBy("hire_date")))
    return whole_day.filter("day_changed").select(*stored.columns, "is_changed")


def refresh_station_days(rides: DataFrame, stations: DataFrame, path: str, days: list[date]) -> list[date]:
    """Bring the stored table up to date after rides of ``days`` have been loaded; the days that were rewritten.

    The new days are staged before any directory is replaced, since they are read from the table itself. A run that dies
    is repeated: counting the same days again gives the same rows.
    """
    if not days:
        return []
    spark = rides.sparkSession
    stored = read_station_days(spark, path)
    staged = f"{path.rstrip('/')}-staged"
    refreshed_rows(rides, stations, stored, days).drop("is_changed").write.mode("overwrite").parquet(staged)
    fresh = spark.read.schema(stored.schema).parquet(staged)
    rewritten = touched_days(fresh)
    _write(fresh, path)
    for day in set(days) - set(rewritten):  # no ride of the day is left
        sinks.remove(spark, f"{path}/hire_date={day}")
    sinks.remove(spark, staged)
    return rewritten
