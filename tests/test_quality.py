import pytest
from pyspark.sql import functions as F

from dockflow.operators import quality, schema_tests
from dockflow.plans.warehouse import Warehouse
from tests.frames import ride, rides_frame, station, stations_frame

GOOD_RIDES = [ride(i, "2024-01-02 10:00:00", 600, 1, 2) for i in range(5)]
GOOD_STATIONS = [station(1), station(2)]


def broken(**changes):
    return ride(99, "2024-01-02 10:00:00", 600, 1, 2) | changes


def statuses(results):
    return {r.check_id: r.status for r in results.collect()}


def ingest(spark, rides, stations, **options):
    frame = quality.post_ingest(
        rides_frame(spark, rides), stations_frame(spark, stations), **({"min_rows": 1} | options)
    )
    return statuses(frame)


def test_clean_tables_pass(spark):
    got = ingest(spark, GOOD_RIDES, GOOD_STATIONS)
    assert len(got) == 16 and set(got.values()) == {"PASS"}


@pytest.mark.parametrize(
    "row, failing, status",
    [
        (broken(rental_id=None), {"Q01", "Q02"}, "FAIL"),
        (broken(rental_id=3), {"Q02"}, "FAIL"),
        (broken(start_date=None), {"Q03"}, "FAIL"),
        (ride(99, "2009-12-31 23:00:00", 600, 1, 2), {"Q04"}, "FAIL"),
        (broken(duration=None), {"Q05"}, "FAIL"),
        (broken(duration=59), {"Q06"}, "WARN"),
        (broken(duration=86401), {"Q06"}, "WARN"),
        (broken(start_station_id=None), {"Q07"}, "FAIL"),
        (broken(end_station_id=None), {"Q08"}, "WARN"),
    ],
)
def test_each_ride_defect_is_found(spark, row, failing, status):
    got = ingest(spark, GOOD_RIDES + [row], GOOD_STATIONS)
    assert {c for c, s in got.items() if s != "PASS"} == failing
    assert {got[c] for c in failing} == {status}


def test_end_not_after_start_warns(spark):
    row = broken()
    row["end_date"] = row["start_date"]
    assert ingest(spark, GOOD_RIDES + [row], GOOD_STATIONS)["Q09"] == "WARN"


@pytest.mark.parametrize(
    "row, failing",
    [
        (station(1), "Q12"),
        (station(3, lat=51.29), "Q13"),
        (station(3, lon=0.301), "Q14"),
        (station(3, docks=0), "Q15"),
        (station(3) | {"name": None}, "Q16"),
    ],
)
def test_each_station_defect_is_found(spark, row, failing):
    got = ingest(spark, GOOD_RIDES, GOOD_STATIONS + [row])
    assert {c for c, s in got.items() if s == "FAIL"} == {failing}


def test_row_minimum(spark):
    assert ingest(spark, GOOD_RIDES, GOOD_STATIONS, min_rows=6)["Q10"] == "FAIL"
    assert ingest(spark, GOOD_RIDES, GOOD_STATIONS, min_rows=5)["Q10"] == "PASS"


def test_missing_column_fails_its_checks_only(spark):
    rides = rides_frame(spark, GOOD_RIDES).drop("duration")
    got = statuses(quality.post_ingest(rides, stations_frame(spark, GOOD_STATIONS), 1))
    assert {c for c, s in got.items() if s != "PASS"} == {"Q05", "Q06"}
    assert (got["Q05"], got["Q06"]) == ("FAIL", "FAIL")


def test_null_rate_of_an_empty_fact_fails(spark):
    w = Warehouse(rides_frame(spark, []), stations_frame(spark, GOOD_STATIONS))
    got = statuses(quality.post_transform(w.fact_rides, w.dim_stations, w.dim_date, 1))
    assert {c for c, s in got.items() if s != "PASS"} == {"Q24", "Q27"} and got["Q24"] == "FAIL"


def test_file_checks_treat_unknown_as_broken(spark):
    rides = rides_frame(spark, GOOD_RIDES + [broken(duration=None), broken(rental_id=None), broken(rental_id=None)])
    got = statuses(quality.delivered_files(rides, stations_frame(spark, GOOD_STATIONS), 1, 1))
    assert {c for c, s in got.items() if s == "FAIL"} == {"F01", "F05", "F09", "G04"}


def test_gate(spark):
    rides, stations = rides_frame(spark, GOOD_RIDES), stations_frame(spark, GOOD_STATIONS)
    quality.gate(quality.post_ingest(rides, stations, 1))
    warned = rides_frame(spark, GOOD_RIDES + [broken(end_station_id=None)])
    quality.gate(quality.post_ingest(warned, stations, 1))
    with pytest.raises(quality.QualityError, match="Q10"):
        quality.gate(quality.post_ingest(rides, stations, 100))


def test_mart_checks_find_defects(spark):
    w = Warehouse(rides_frame(spark, GOOD_RIDES), stations_frame(spark, GOOD_STATIONS))
    changes = {
        "Q20": ("start_station_id", F.lit(None).cast("bigint")),
        "Q22": ("start_hour", F.lit(24).cast("bigint")),
        "Q23": ("duration_band", F.lit("huge")),
        "Q26": ("start_station_imbalance_score", F.lit(1.5)),
        "Q19": ("duration_minutes", F.lit(0.5)),
        "Q24": ("start_station_name", F.lit(None).cast("string")),
    }
    for check_id, (name, value) in changes.items():
        got = statuses(quality.post_transform(w.fact_rides.withColumn(name, value), w.dim_stations, w.dim_date, 1))
        assert {c for c, s in got.items() if s != "PASS"} == {check_id}, check_id


def test_orphans_are_counted_and_null_is_none(spark):
    child = spark.createDataFrame([(1,), (7,), (7,), (8,), (None,)], "k bigint")
    parent = spark.createDataFrame([(1,)], "id bigint")
    got = {(r.key, r.rows) for r in quality.orphan_keys(child, "k", parent, "id").collect()}
    assert got == {(7, 2), (8, 1)}


def test_schema_tests_find_defects(spark):
    bad = [station(1, docks=101), station(1), station(3)]
    w = Warehouse(rides_frame(spark, GOOD_RIDES + [broken(end_station_id=None)]), stations_frame(spark, bad))
    tables = {
        "cycle_hire": w.raw_rides,
        "cycle_stations": w.raw_stations,
        "stg_cycle_hire": w.stg_rides,
        "stg_cycle_stations": w.stg_stations,
    }
    results = schema_tests.run_schema_tests(schema_tests.STAGING_TESTS, tables)
    failing = {
        (r.model, r.column_name, r.test): (r.failures, r.status) for r in results.collect() if r.status != "PASS"
    }
    assert failing == {
        ("cycle_hire", "end_station_id", "not_null"): (1, "WARN"),
        ("stg_cycle_hire", "end_station_id", "not_null"): (1, "WARN"),
        ("cycle_stations", "id", "unique"): (1, "ERROR"),
        ("stg_cycle_stations", "station_id", "unique"): (1, "ERROR"),
        ("stg_cycle_stations", "nb_docks", "accepted_range"): (1, "ERROR"),
    }
    with pytest.raises(quality.QualityError, match="nb_docks"):
        quality.gate(schema_tests.as_check_results(results, "schema_tests"))


def test_relationship_counts_rows(spark):
    w = Warehouse(
        rides_frame(spark, GOOD_RIDES + [ride(50, "2024-01-02 10:00:00", 600, 7, 2)]),
        stations_frame(spark, GOOD_STATIONS),
    )
    tables = {"fact_rides": w.fact_rides, "dim_stations": w.dim_stations, "dim_date": w.dim_date}
    results = schema_tests.run_schema_tests(schema_tests.MART_TESTS, tables)
    row = results.filter("test = 'relationships'").first()
    assert (row.failures, row.status) == (1, "WARN")


def test_reversed_rides_are_listed(spark):
    w = Warehouse(rides_frame(spark, GOOD_RIDES), stations_frame(spark, GOOD_STATIONS))
    assert schema_tests.rides_ending_before_start(w.fact_rides).count() == 0
    turned = w.fact_rides.withColumn("end_datetime", F.when(F.col("rental_id") < 2, F.col("start_datetime")))
    assert schema_tests.rides_ending_before_start(turned).count() == 2


def test_results_survive_the_sink(spark, tmp_path):
    rides, stations = rides_frame(spark, GOOD_RIDES), stations_frame(spark, GOOD_STATIONS)
    results = quality.post_ingest(rides, stations, 100)
    back = quality.read_results(spark, quality.save_results(results, str(tmp_path / "checks")))
    assert statuses(back) == statuses(results)
    counts = {(r.checkpoint, r.status): r.checks for r in quality.status_counts(back).collect()}
    assert counts == {("post_ingest", "PASS"): 15, ("post_ingest", "FAIL"): 1}
    header = quality.overall(back).first()
    assert (header.overall_status, header.checks, header.failed) == ("FAIL", 16, 1)
