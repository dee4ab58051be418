from datetime import datetime
from pathlib import Path
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from dockflow.operators import trends
from dockflow.plans import marts
from dockflow.plans.warehouse import Warehouse
from dockflow.sources import readers, schemas, sinks, testdata
from tests.conftest import SMALL
from tests.frames import ride, rides_frame, rows, station, stations_frame


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_rides_csv_round_trip(spark, tmp_path):
    rides = rides_frame(spark, [ride(1, "2024-01-02 10:00:01", 61, 1, None), ride(2, "2024-06-30 23:59:59", 60, 2, 1)])
    path = sinks.write_csv(rides, str(tmp_path / "rides"))
    back = readers.read_rides_csv(spark, path)
    assert rows(back) == rows(rides)
    assert [f.dataType for f in back.schema] == [f.dataType for f in schemas.RIDES]


def test_stations_csv_accepts_the_other_dock_name(spark, tmp_path):
    stations = stations_frame(spark, [station(1, docks=17), station(2)])
    path = sinks.write_csv(stations.withColumnRenamed("docks_count", "nbdocks"), str(tmp_path / "st"))
    back = readers.read_stations_csv(spark, path, dock_column="nbdocks")
    assert rows(back.select(stations.columns)) == rows(stations)


def test_schema_presence(spark):
    rides = rides_frame(spark, []).drop("bike_id")
    stations = stations_frame(spark, []).withColumnRenamed("docks_count", "nbdocks")
    listed = readers.schema_presence({"cycle_hire": rides, "cycle_stations": stations})
    assert [tuple(r) for r in listed.filter("NOT present").collect()] == [("cycle_hire", "bike_id", False, 0)]
    readers.require_columns("cycle_stations", stations)
    with pytest.raises(ValueError, match="bike_id"):
        readers.require_columns("cycle_hire", rides)


def test_column_listing_keeps_order(spark):
    table = rides_frame(spark, [ride(1, "2024-01-01 10:00:00", 60, 1, None)])
    listed = readers.column_listing(table).collect()
    assert [r.column_name for r in listed] == schemas.RIDES.fieldNames()
    assert listed[3].data_type == "timestamp" and listed[3].ordinal_position == 4
    assert [r.filled for r in listed] == [1, 1, 1, 1, 0, 0, 1, 1, 1]


def test_incremental_window_is_open_below_and_closed_above(spark):
    rides = rides_frame(spark, [ride(i, f"2024-01-0{i} 10:00:00", 60, 1, 1) for i in range(1, 6)])
    after = F.lit("2024-01-02 10:00:00").cast("timestamp")
    until = F.lit("2024-01-04 10:00:00").cast("timestamp")
    picked = readers.incremental(rides, "start_date", after, until)
    assert {r.rental_id for r in picked.collect()} == {3, 4}
    assert {r.rental_id for r in readers.incremental(rides, "start_date", after).collect()} == {3, 4, 5}
    assert readers.high_water_mark(picked, "start_date").first()[0] == datetime(2024, 1, 4, 10)


def test_record_validation_splits_a_feed(spark):
    good = ("1", "600", "5", "2024-01-01 10:10:00", "2", "B", "2024-01-01 10:00:00", "1", "A")
    names = schemas.RIDES.fieldNames()

    def variant(**changes):
        return tuple(changes.get(n, v) for n, v in zip(names, good))

    feed = spark.createDataFrame(
        [
            good,
            variant(rental_id="2", end_station_id=None),
            variant(rental_id=None),
            variant(rental_id="3", duration="ten"),
            variant(rental_id="4", start_date="yesterday", duration="x"),
            variant(rental_id="5.5"),
        ],
        ", ".join(f"{n} string" for n in names),
    )
    validated = readers.validate_records(feed, schemas.RIDES)
    accepted = readers.accepted_records(validated, schemas.RIDES)
    assert {r.rental_id for r in accepted.collect()} == {1, 2}
    assert [f.dataType for f in accepted.schema] == [f.dataType for f in schemas.RIDES]
    rejected = {r.rental_id: r.rejected_for for r in readers.rejected_records(validated, schemas.RIDES).collect()}
    assert rejected == {None: "rental_id", "3": "duration", "4": "duration", "5.5": "rental_id"}


def test_load_replaces_and_adds_metadata(spark, tmp_path):
    path = str(tmp_path / "raw")
    sinks.load_raw(rides_frame(spark, [ride(i, "2024-01-01 10:00:00", 60, 1, 1) for i in range(9)]), schemas.RIDES, path)
    sinks.load_raw(rides_frame(spark, [ride(i, "2024-01-01 10:00:00", 60, 1, 1) for i in range(3)]), schemas.RIDES, path, 2)
    loaded = spark.read.parquet(path)
    assert loaded.count() == 3
    assert loaded.select("_sdc_sequence").distinct().count() == 3
    assert {r[0] for r in loaded.select("_sdc_table_version").collect()} == {2}


def test_shared_folder_is_the_one_the_session_names(spark):
    assert sinks.fresh_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_without_that_folder_the_warehouse_holds_intermediates():
    context = SimpleNamespace(applicationId="app-1")
    session = SimpleNamespace(conf={"spark.sql.warehouse.dir": "file:/shared/warehouse/"}, sparkContext=context)
    assert sinks.shared_folder(session) == "file:/shared/warehouse/dockflow/app-1"


def test_intermediates_are_removed(spark, tmp_path):
    path = sinks.write_table(spark.range(3), str(tmp_path / "x"))
    sinks.remove(spark, path)
    assert not (tmp_path / "x").exists()


def test_stored_fact_is_complete_and_pruned_by_day(spark, tmp_path):
    w = Warehouse(testdata.cycle_hire(spark, SMALL), testdata.cycle_stations(spark, SMALL))
    path = sinks.write_fact(w.fact_rides, str(tmp_path / "fact"))
    fact = sinks.read_fact(spark, path, marts.FACT_COLUMNS)
    assert rows(fact) == rows(w.fact_rides)
    days = {p.name for p in Path(path).glob("hire_date=*")}
    assert len(days) == w.fact_rides.select("hire_date").distinct().count()
    plan = plan_of(trends.daily_trend(fact, "2024-01-05", "2024-01-06"))
    assert "PartitionFilters: [isnotnull(hire_date" in plan and "ReadSchema: struct<>" in plan


def test_busy_day_is_written_by_several_tasks(spark, tmp_path):
    """One day holds nearly all rides; adaptive execution cuts it into pieces of the advised size."""
    n = 60_000
    day = F.when(F.col("id") % 50 == 0, F.lit("2024-01-02")).otherwise("2024-01-01").cast("date")
    fact = spark.range(0, n, 1, 8).select(
        F.col("id").alias("rental_id"),
        day.alias("hire_date"),
        F.pmod(F.xxhash64("id"), F.lit(3)).alias("start_station_id"),
        F.pmod(F.xxhash64("id"), F.lit(5)).alias("end_station_id"),
        F.sha2(F.col("id").cast("string"), 512).alias("payload"),
    )
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1MB")
    try:
        path = sinks.write_fact(fact, str(tmp_path / "fact"))
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    busy = list(Path(path, "hire_date=2024-01-01").glob("*.parquet"))
    assert len(busy) > 3
    assert spark.read.parquet(path).count() == n
    # Rows of every file are in Z-order of both stations.
    place = sinks.z_value(F.col("start_station_id"), F.col("end_station_id"))
    one = spark.read.parquet(str(busy[0])).select(place).collect()
    assert [r[0] for r in one] == sorted(r[0] for r in one)


def test_staging_filters_reach_the_scan(spark, tmp_path):
    path = sinks.write_table(rides_frame(spark, [ride(1, "2024-01-01 10:00:00", 60, 1, 1)]), str(tmp_path / "raw"))
    w = Warehouse(readers.read_table(spark, path, schemas.RIDES), stations_frame(spark, []))
    plan = plan_of(trends.daily_trend(w.banded_rides, "2024-01-01", "2024-01-30"))
    assert "GreaterThanOrEqual(duration,60)" in plan and "LessThanOrEqual(duration,86400)" in plan
    assert "ReadSchema: struct<rental_id:bigint,duration:bigint,end_date:timestamp,start_date:timestamp>" in plan
