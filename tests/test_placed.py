import random

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from dockflow.plans import marts, placed
from dockflow.plans.warehouse import Warehouse
from dockflow.sources import sinks
from tests.frames import ride, rides_frame, rows, station, stations_frame


def warehouse(spark, count=400, hot=False):
    rng = random.Random(3)
    rides = []
    for i in range(count):
        day = 5 if hot and i % 2 else rng.randint(1, 9)
        start, end = rng.randint(1, 8), rng.choice([None, None, 1, 2, 3, 4, 9])
        rides.append(ride(i, f"2024-01-{day:02d} {i % 24:02d}:05:00", rng.choice([30, 600, 900]), start, end))
    return Warehouse(rides_frame(spark, rides), stations_frame(spark, [station(i, docks=9 + i) for i in range(1, 8)]))


@pytest.mark.parametrize("per_piece", [10, 500_000])
def test_placed_fact_has_the_rows_of_the_fact(spark, tmp_path, per_piece):
    w = warehouse(spark, hot=True).with_stored_daily(str(tmp_path / "daily"))
    fact = placed.placed_fact(w.banded_rides, w.stg_stations, w.station_daily, per_piece)
    path = placed.write_placed_fact(fact, str(tmp_path / "fact"))
    assert rows(sinks.read_fact(spark, path, marts.FACT_COLUMNS)) == rows(w.fact_rides)
    if per_piece == 10:
        pieces = {(r["hire_date"].day, r["piece"]) for r in fact.select("hire_date", "piece").distinct().collect()}
        assert len({p for d, p in pieces if d == 5}) > 10


def test_one_exchange_of_rides_without_broadcasts(spark, tmp_path):
    w = warehouse(spark).with_stored_daily(str(tmp_path / "daily"))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fact = placed.placed_fact(w.banded_rides, w.stg_stations, w.station_daily, 50)
        plan = fact.sortWithinPartitions("hire_date")._jdf.queryExecution().executedPlan().toString()
        before = w.fact_rides._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)

    def of_ride_size(text):  # rides are the only rows with a bike
        exchanges, lines = 0, text.splitlines()
        for i, line in enumerate(lines):
            if "Exchange" in line:
                below = next((x for x in lines[i + 1 :] if "Project" in x or "Scan" in x), "")
                exchanges += "bike_id" in below
        return exchanges

    assert "SortMergeJoin" in plan and "Broadcast" not in plan
    assert of_ride_size(plan) == 1
    assert of_ride_size(before) >= 2


def interleaved(a, b, bits):
    return sum(((a >> i & 1) << (2 * i + 1)) | ((b >> i & 1) << (2 * i)) for i in range(bits))


@pytest.mark.parametrize("bits", [3, 20, 31])
def test_z_value(spark, bits):
    rng = random.Random(bits)
    most = (1 << bits) - 1
    pairs = [(rng.randint(0, most), rng.randint(0, most)) for _ in range(200)] + [(0, 0), (most, 0), (0, most), (most, most)]
    frame = spark.createDataFrame([(a, b) for a, b in pairs] + [(None, 1), (5 << 40, -7)], "a bigint, b bigint")
    found = [r.z for r in frame.select("a", "b", sinks.z_value(F.col("a"), F.col("b"), bits).alias("z")).collect()]
    assert found == [interleaved(a, b, bits) for a, b in pairs] + [interleaved(most, 1, bits), interleaved(most, 0, bits)]


def test_a_filter_on_either_station_prunes_row_groups(spark, tmp_path):
    n = 40_000
    day = spark.range(n).select(
        F.lit("2024-01-01").cast("date").alias("hire_date"),
        F.pmod(F.xxhash64("id"), F.lit(800)).alias("start_station_id"),
        F.pmod(F.xxhash64("id", F.lit(1)), F.lit(800)).alias("end_station_id"),
        F.repeat(F.sha2(F.col("id").cast("string"), 256), 4).alias("wide"),
    )
    key = "parquet.block.size"
    configuration = spark._jsc.hadoopConfiguration()
    configuration.set(key, str(128 * 1024))
    try:
        path = sinks.write_days(day.coalesce(1), str(tmp_path / "fact"))
    finally:
        configuration.unset(key)
    (file,) = (tmp_path / "fact").glob("hire_date=*/*.parquet")
    meta = pq.ParquetFile(file).metadata
    assert meta.num_row_groups >= 60
    names = [meta.schema.column(i).name for i in range(meta.num_columns)]
    for column in ("start_station_id", "end_station_id"):
        at = names.index(column)
        ranges = [meta.row_group(g).column(at).statistics for g in range(meta.num_row_groups)]
        for wanted in (0, 399, 400, 799):
            read = sum(s.min <= wanted <= s.max for s in ranges)
            assert 0 < read <= meta.num_row_groups / 3
    assert spark.read.parquet(path).count() == n
