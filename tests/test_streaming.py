import re

import pytest
from pyspark.sql import functions as F

from dockflow.sources import bookmarks, increments, sinks
from dockflow.sources.keyindex import KeyIndex
from dockflow.streaming import incremental
from tests.frames import ride, rides_frame, rows

SMALL = {"buckets": 8, "cells": 64}


def load(spark, source, target, state, **options):
    incremental.load_available(incremental.ride_stream(spark, source, **options), target, state, **SMALL)


def ids(spark, target):
    return sorted(r.rental_id for r in increments.loaded(spark, target).collect())


def test_runs_pick_up_new_files_once(spark, tmp_path):
    source, target, state = (str(tmp_path / n) for n in ("source", "target", "state"))
    first = [ride(i, f"2024-01-{i:02d} 10:00:00", 600, 1, 2) for i in range(10, 20)]
    rides_frame(spark, first + first[:3]).write.mode("append").parquet(source)
    load(spark, source, target, state)
    assert rows(incremental.loaded(spark, target)) == rows(rides_frame(spark, first))

    # New rides, repeats of loaded ones, and a ride that is more than a year late.
    late = ride(1, "2022-06-01 10:00:00", 600, 1, None)
    new = [ride(i, f"2024-02-{i:02d} 10:00:00", 600, 2, 1) for i in range(20, 25)]
    rides_frame(spark, new + first[5:] + [late]).write.mode("append").parquet(source)
    load(spark, source, target, state)
    assert rows(incremental.loaded(spark, target)) == rows(rides_frame(spark, first + new + [late]))

    load(spark, source, target, state)
    assert incremental.loaded(spark, target).count() == 16


def test_several_batches_equal_one(spark, tmp_path):
    source = str(tmp_path / "source")
    everything = [ride(i, f"2024-01-{1 + i % 28:02d} 10:00:00", 600, i % 3, i % 2) for i in range(60)]
    rides_frame(spark, everything).repartition(3).write.parquet(source)
    target = str(tmp_path / "target")
    load(spark, source, target, str(tmp_path / "state"), max_files=1)
    assert rows(incremental.loaded(spark, target)) == rows(rides_frame(spark, everything))


def test_a_checkpoint_made_anew_at_the_same_path_loses_nothing(spark, tmp_path):
    target, state = str(tmp_path / "target"), str(tmp_path / "state")
    for name, numbers in (("a", range(5)), ("b", range(5, 8)), ("c", [1, 6])):
        source = str(tmp_path / f"source-{name}")
        rides_frame(spark, [ride(i, f"2024-01-0{1 + i} 10:00:00", 600, 1, 2) for i in numbers]).write.parquet(source)
        load(spark, source, target, state)
        sinks.remove(spark, state)
    assert ids(spark, target) == list(range(8))
    assert len(bookmarks.every(spark, target)) == 3
    assert "hire_date=2024-01-03" in {p.name for p in (tmp_path / "target").iterdir()}


def test_a_corrected_start_is_the_same_ride(spark, tmp_path):
    source, target, state = (str(tmp_path / n) for n in ("source", "target", "state"))
    for day in ("2024-01-01", "2024-01-02"):
        rides_frame(spark, [ride(1, f"{day} 10:00:00", 600, 1, 2)]).write.mode("append").parquet(source)
        load(spark, source, target, state)
    assert [r.start_date.day for r in incremental.loaded(spark, target).collect()] == [1]


def test_a_second_try_takes_the_same_delivery(spark, tmp_path, monkeypatch):
    """Two deliveries of a ride on different days; the first try dies after its rides are written."""
    target = str(tmp_path / "target")
    two = [ride(1, "2024-01-02 10:00:00", 600, 1, 2), ride(1, "2024-01-01 10:00:00", 600, 1, 2)]
    commit = bookmarks.commit

    def die(*_):
        raise RuntimeError("executor lost")

    monkeypatch.setattr(bookmarks, "commit", die)
    with pytest.raises(RuntimeError):
        increments.append_batch(rides_frame(spark, two[:1]), target, "l", 0, **SMALL)
    monkeypatch.setattr(bookmarks, "commit", commit)
    assert ids(spark, str(tmp_path / "target")) == []  # nothing is visible before the commit
    for order in (two, two[::-1]):
        increments.append_batch(rides_frame(spark, order).coalesce(1), target, "l", 0, **SMALL)
        assert [r.start_date.day for r in increments.loaded(spark, target).collect()] == [1]
    assert {p.name for p in (tmp_path / "target").iterdir() if p.name.startswith("hire_date")} >= {"hire_date=2024-01-01"}


@pytest.mark.parametrize("dies_in", ["keys", "commit"])
def test_bookmarked_runs_survive_a_death_before_the_commit(spark, tmp_path, monkeypatch, dies_in):
    target = str(tmp_path / "target")
    table = rides_frame(spark, [ride(i, f"2024-01-{1 + i // 2:02d} 10:00:00", 600, 1, 2) for i in range(20)])
    day = lambda n: F.lit(f"2024-01-{n:02d} 10:00:00").cast("timestamp")
    first = increments.load_increment(table, target, "daily", start=day(2), until=day(4), **SMALL)
    assert (first.batch_id, first.rides, first.high_water) == (0, 6, "2024-01-04 10:00:00.000000")

    def die(*_):
        raise RuntimeError("driver lost")

    place = (KeyIndex, "add") if dies_in == "keys" else (bookmarks, "commit")
    with monkeypatch.context() as m, pytest.raises(RuntimeError):
        m.setattr(*place, die)
        increments.load_increment(table, target, "daily", until=day(7), **SMALL)
    assert ids(spark, target) == list(range(2, 8))
    assert bookmarks.read(spark, target, "daily") == first

    second = increments.load_increment(table, target, "daily", until=day(7), **SMALL)
    assert (second.batch_id, second.rides) == (1, 12)
    third = increments.load_increment(table, target, "daily", **SMALL)
    assert (third.batch_id, third.rides) == (2, 18)
    assert increments.load_increment(table, target, "daily", **SMALL).rides == 18  # nothing new
    assert ids(spark, target) == list(range(2, 20))
    history = {r.batch_id: r.rides for r in increments.load_history(spark, target).collect()}
    assert history == {0: 6, 1: 6, 2: 6}


def test_a_batch_reads_a_part_of_the_keys(spark, tmp_path):
    target = str(tmp_path / "target")
    day = "2024-01-01 10:00:00"
    sizes = {"buckets": 16, "cells": 256}
    for batch, numbers in enumerate([range(3000), range(3000, 5000), [*range(5000, 5400), 17, 4321]]):
        increments.append_batch(rides_frame(spark, [ride(i, day, 60, 1, 2) for i in numbers]), target, "l", batch, **sizes)
    assert increments.loaded(spark, target).count() == 5400
    assert increments.loaded(spark, target).select("rental_id").distinct().count() == 5400

    index, done = increments.key_index(spark, target, **sizes), bookmarks.committed(spark, target)
    asked = spark.createDataFrame([(i,) for i in [*range(9000, 9200), 17, 4321]], "rental_id bigint")
    suspects = index.suspects(asked, done)
    assert {17, 4321} <= {r.rental_id for r in suspects.collect()}
    assert suspects.count() < 20  # of 202: the filters answer for the rest
    buckets = [r.bucket for r in suspects.select("bucket").distinct().collect()]
    read = index.stored_keys(buckets, done)
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[.*bucket", plan), plan
    files = {r[0] for r in read.select(F.input_file_name()).distinct().collect()}
    assert len({f.split("bucket=")[1].split("/")[0] for f in files}) == len(buckets) < 16
    assert read.count() < 5400
    assert {r.rental_id for r in index.known(asked, done).collect()} == {17, 4321}
    nothing = spark.createDataFrame([(-5,)], "rental_id bigint")
    assert index.known(nothing, done) is None  # no bucket is read at all


def test_filters_miss_no_key(spark, tmp_path):
    index = KeyIndex(spark, str(tmp_path / "keys"), "rental_id", buckets=4, cells=2)  # far too few cells
    keys = spark.range(20_000).withColumnRenamed("id", "rental_id")
    index.add(keys, "l", 0)
    assert index.suspects(keys, F.lit(True)).count() == 20_000
    assert index.known(keys, F.lit(True)).count() == 20_000
