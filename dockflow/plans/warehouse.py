"""The warehouse as a set of lazy tables, and the gated run that stores it."""

import uuid
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from dockflow.operators import explore, quality, schema_tests
from dockflow.plans import enrich, marts, placed, staging
from dockflow.sources import readers, sinks


class Warehouse:
    """Tables derived from raw rides and stations. Nothing runs until a table is used."""

    def __init__(self, raw_rides: DataFrame, raw_stations: DataFrame):
        self.raw_rides = raw_rides
        self.raw_stations = readers.rename_aliases(raw_stations)
        self.spark: SparkSession = raw_rides.sparkSession

    @cached_property
    def stg_rides(self) -> DataFrame:
        return staging.stg_rides(self.raw_rides)

    @cached_property
    def stg_stations(self) -> DataFrame:
        return staging.stg_stations(self.raw_stations)

    @cached_property
    def banded_rides(self) -> DataFrame:
        return enrich.banded_rides(self.stg_rides)

    @cached_property
    def rides_enriched(self) -> DataFrame:
        return enrich.rides_enriched(self.banded_rides, self.stg_stations)

    @cached_property
    def station_daily(self) -> DataFrame:
        return enrich.station_daily_stats(self.banded_rides, self.stg_stations)

    @cached_property
    def station_day_rides(self) -> DataFrame:
        return enrich.station_day_rides(self.banded_rides, self.stg_stations)

    @cached_property
    def dim_date(self) -> DataFrame:
        return marts.dim_date(self.spark)

    @cached_property
    def dim_stations(self) -> DataFrame:
        return marts.dim_stations(self.stg_stations, self.station_daily)

    @cached_property
    def fact_rides(self) -> DataFrame:
        """The fact as a view: nothing is stored, the daily flow is counted within the query."""
        return marts.fact_rides(self.rides_enriched, self.station_daily)

    @cached_property
    def placed_fact(self) -> DataFrame:
        """The same rows as they are stored: one shuffle of rides. It counts the rides of each day when it is built."""
        return placed.placed_fact(self.banded_rides, self.stg_stations, self.station_daily)

    def with_stored_daily(self, path: str) -> "Warehouse":
        """The same tables, the daily flow counted once and read from ``path`` by all of them.

        It is small, several tables read it, and Spark knows its bytes when it plans the fact's join. A
        lost executor costs a re-read instead of a re-count of all rides.
        """
        stored = Warehouse(self.raw_rides, self.raw_stations)
        daily = self.spark.read.schema(self.station_daily.schema).parquet(
            sinks.write_table(self.station_daily, path)
        )
        stored.station_daily = daily
        stored.fact_rides = marts.fact_rides(stored.rides_enriched, daily)
        return stored

    @cached_property
    def explored(self) -> DataFrame:
        return explore.explored(self.raw_rides)

    def create_views(self) -> None:
        """Register the lazy tables under their names for SQL users."""
        views = {
            "stg_cycle_hire": self.stg_rides,
            "stg_cycle_stations": self.stg_stations,
            "int_rides_enriched": self.rides_enriched,
            "int_station_daily_stats": self.station_daily,
            "dim_date": self.dim_date,
            "dim_stations": self.dim_stations,
            "fact_rides": self.fact_rides,
        }
        for name, table in views.items():
            table.createOrReplaceTempView(name)


@dataclass(frozen=True)
class PublishSettings:
    min_rows: int = 1_000_000


@dataclass(frozen=True)
class Published:
    """Stored tables and the check results that cleared them."""

    daily: DataFrame
    dim_date: DataFrame
    dim_stations: DataFrame
    fact_rides: DataFrame
    checks: DataFrame


POINTER = "current"


def publish(
    warehouse: Warehouse, folder: str, settings: PublishSettings | None = None
) -> Published:
    """Check the raw tables, store the marts, check the marts, then switch readers to them.

    Each run writes to a folder of its own; ``folder/current`` names the last one that passed every gate, so a failed run
    leaves what readers see as it was. The small daily table is checked before rides are joined to it: two rows for a
    station and day would multiply rides. A failed gate raises.
    """
    settings = settings or PublishSettings()
    spark = warehouse.spark
    run = f"{folder}/runs/{uuid.uuid4().hex}"
    ingest = quality.post_ingest(warehouse.raw_rides, warehouse.raw_stations, settings.min_rows)
    ingest_path = quality.save_results(ingest, f"{run}/checks/post_ingest")
    quality.gate(quality.read_results(spark, ingest_path))

    stored = warehouse.with_stored_daily(f"{run}/int_station_daily_stats")
    quality.gate(quality.one_row_per_station_day(stored.station_daily))
    days = spark.read.parquet(sinks.write_table(stored.dim_date, f"{run}/dim_date"))
    stations = spark.read.parquet(sinks.write_table(stored.dim_stations, f"{run}/dim_stations"))
    fact_path = placed.write_placed_fact(stored.placed_fact, f"{run}/fact_rides")
    fact = sinks.read_fact(spark, fact_path, marts.FACT_COLUMNS)

    tables = {"fact_rides": fact, "dim_stations": stations, "dim_date": days}
    tests = schema_tests.run_schema_tests(schema_tests.MART_TESTS, tables)
    transform = quality.union_all(
        [
            quality.post_transform(fact, stations, days, settings.min_rows),
            schema_tests.as_check_results(tests, "schema_tests"),
        ]
    )
    transform_path = quality.save_results(transform, f"{run}/checks/post_transform")
    quality.gate(quality.read_results(spark, transform_path))
    sinks.point(spark, f"{folder}/{POINTER}", run)
    return published(spark, folder)


def published(spark: SparkSession, folder: str) -> Published:
    """The tables of the last run that passed."""
    run = sinks.pointed(spark, f"{folder}/{POINTER}")
    checks = [quality.read_results(spark, f"{run}/checks/{name}") for name in ("post_ingest", "post_transform")]
    return Published(
        spark.read.parquet(f"{run}/int_station_daily_stats"),
        spark.read.parquet(f"{run}/dim_date"),
        spark.read.parquet(f"{run}/dim_stations"),
        sinks.read_fact(spark, f"{run}/fact_rides", marts.FACT_COLUMNS),
        quality.union_all(checks),
    )
