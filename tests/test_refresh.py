import random

import pytest
from pyspark.sql import functions as F

from dockflow.plans import refresh, staging
from dockflow.sources import increments
from dockflow.streaming import incremental, station_days
from tests.frames import ride, rides_frame, rows, station, stations_frame

SMALL = {"buckets": 4, "cells": 16}


def some_rides(count, seed, days=range(1, 29), first=0):
    rng = random.Random(seed)
    out = []
    for i in range(count):
        start, end = rng.randint(1, 6), rng.choice([None, 1, 2, 3, 7])
        day, hour = rng.choice(list(days)), rng.randint(0, 23)
        name = "Other name" if rng.random() < 0.03 else None
        out.append(ride(first + i, f"2024-01-{day:02d} {hour:02d}:15:00", rng.choice([30, 600, 1200]), start, end, name))
    return out


@pytest.fixture
def stations(spark):
    return staging.stg_stations(stations_frame(spark, [station(i, docks=10 + i) for i in range(1, 6)]))


def days_equal(spark, rides, stations, path, tmp_path):
    rebuilt = str(tmp_path / "rebuilt")
    refresh.build_station_days(rides, stations, rebuilt)
    return rows(refresh.read_station_days(spark, path)) == rows(refresh.read_station_days(spark, rebuilt))


def test_refresh_equals_a_full_rebuild(spark, tmp_path, stations):
    target, daily = str(tmp_path / "rides"), str(tmp_path / "daily")
    increments.append_batch(rides_frame(spark, some_rides(400, 1, [*range(1, 10), *range(12, 29)])), target, "a", 0, **SMALL)
    refresh.build_station_days(increments.stored_rides(spark, target), stations, daily)
    for batch, (count, days) in enumerate([(5, [3]), (40, [10, 11]), (3, [28]), (2, [1])], 1):
        late = rides_frame(spark, some_rides(count, 10 + batch, days, first=1000 * batch))
        increments.append_batch(late, target, "a", batch, **SMALL)
        rides = increments.stored_rides(spark, target)
        touched = refresh.touched_days(rides.filter(F.col("batch_id") == batch))
        rewritten = refresh.refresh_station_days(rides, stations, daily, touched)
        assert {d.day for d in rewritten} >= {d for d in days if d in {t.day for t in touched}}
        assert days_equal(spark, rides, stations, daily, tmp_path)
        assert not (tmp_path / "daily-staged").exists()


def test_only_touched_days_are_read_and_few_are_rewritten(spark, tmp_path, stations):
    target, daily = str(tmp_path / "rides"), str(tmp_path / "daily")
    everyday = [ride(100 * d + s, f"2024-01-{d:02d} 10:00:00", 600, s, 1) for d in range(1, 29) for s in range(1, 5)]
    increments.append_batch(rides_frame(spark, everyday), target, "a", 0, **SMALL)
    refresh.build_station_days(increments.stored_rides(spark, target), stations, daily)
    before = {p.name: p.stat().st_mtime_ns for p in (tmp_path / "daily").glob("hire_date=*")}
    increments.append_batch(rides_frame(spark, [ride(9999, "2024-01-05 12:00:00", 600, 2, 1)]), target, "a", 1, **SMALL)
    rides = increments.stored_rides(spark, target)
    day = refresh.touched_days(rides.filter("batch_id = 1"))
    plan = refresh.refreshed_rows(rides, stations, refresh.read_station_days(spark, daily), day)
    assert "hire_date" in plan._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: [", 1)[1][:200]
    rewritten = refresh.refresh_station_days(rides, stations, daily, day)
    assert [d.day for d in rewritten] == [5, 6, 7, 8, 9, 10, 11]  # its rolling means reach six active days on
    after = {p.name: p.stat().st_mtime_ns for p in (tmp_path / "daily").glob("hire_date=*")}
    assert {n for n in after if after[n] != before[n]} == {f"hire_date=2024-01-{d:02d}" for d in range(5, 12)}
    assert days_equal(spark, rides, stations, daily, tmp_path)


def by_day(spark, everything, source):
    for low in (1, 11, 21):
        part = [r for r in everything if low <= r["start_date"].day < low + 10]
        rides_frame(spark, part).coalesce(1).write.mode("append").parquet(source)


def test_station_days_of_a_stream(spark, tmp_path):
    source, closed, state = (str(tmp_path / n) for n in ("source", "closed", "state"))
    everything = some_rides(300, 5)
    by_day(spark, everything, source)
    stream = incremental.ride_stream(spark, source, max_files=1)
    station_days.count_available(stream, closed, state, delay="3 days")
    counted = station_days.counted_days(spark, closed, state)
    banded = refresh.banded_rides(staging.stg_rides(rides_frame(spark, everything)))
    expected = banded.groupBy("hire_date", "start_station_id", "start_station_name").agg(
        F.count("*"), F.sum("peak_hour_flag"), F.sum("duration_minutes")
    )
    assert rows(counted.drop("is_closed")) == rows(expected)
    closing = {r["hire_date"].day: r["is_closed"] for r in counted.collect()}
    assert closing == {d: d <= 24 for d in closing}  # the last ride starts on day 28
    assert station_days.late_departures(rides_frame(spark, everything), counted).count() == 0

    # A second run: one ride of an open day, one of a day that has closed.
    more = [ride(5000, "2024-01-28 23:00:00", 600, 2, 1), ride(5001, "2024-01-02 08:00:00", 600, 2, 1)]
    rides_frame(spark, more).coalesce(1).write.mode("append").parquet(source)
    station_days.count_available(stream, closed, state, delay="3 days")
    counted = station_days.counted_days(spark, closed, state)
    late = station_days.late_departures(rides_frame(spark, everything + more), counted).collect()
    assert [(r["hire_date"].day, r["station_id"], r["late_rides"]) for r in late] == [(2, 2, 1)]
    assert counted.agg(F.sum("total_departures")).first()[0] == expected.agg(F.sum("count(1)")).first()[0] + 1


def test_a_batch_that_is_tried_again_replaces_its_days(spark, tmp_path):
    source, closed, state = (str(tmp_path / n) for n in ("source", "closed", "state"))
    by_day(spark, some_rides(100, 6), source)
    stream = incremental.ride_stream(spark, source, max_files=1)
    station_days.count_available(stream, closed, state, delay="1 day")
    before = rows(station_days.counted_days(spark, closed, state))
    last = max((tmp_path / "state" / "commits").iterdir(), key=lambda p: int(p.name) if p.name.isdigit() else -1)
    last.unlink()  # as if the run had died after its rows were written
    for checksum in (tmp_path / "state" / "commits").glob(f".{last.name}.crc"):
        checksum.unlink()
    station_days.count_available(stream, closed, state, delay="1 day")
    assert rows(station_days.counted_days(spark, closed, state)) == before
