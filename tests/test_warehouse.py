"""Warehouse tables on hand-made rides and on the given tables."""

import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from dockflow.operators import quality, schema_tests
from dockflow.plans import catalog, enrich, marts
from dockflow.plans.warehouse import POINTER, PublishSettings, Warehouse, publish, published
from dockflow.sources import sinks, testdata
from tests.conftest import MEDIUM, SMALL
from tests.frames import column, ride, rides_frame, rows, station, stations_frame


def build(spark, rides, stations):
    return Warehouse(rides_frame(spark, rides), stations_frame(spark, stations))


def given(spark, folder):
    return Warehouse(testdata.cycle_hire(spark, folder), testdata.cycle_stations(spark, folder))


def test_staging_keeps_valid_durations_only(spark):
    lengths = [59, 60, 86400, 86401, None]
    rides = [ride(i, "2024-01-02 08:00:00", s, 1, 2) for i, s in enumerate(lengths)]
    rides.append(ride(None, "2024-01-02 08:00:00", 600, 1, 2))
    backwards = ride(9, "2024-01-02 08:00:00", 600, 1, 2)
    backwards["end_date"] = backwards["start_date"]
    staged = build(spark, rides + [backwards], [station(1)]).stg_rides
    assert column(staged, "rental_id", "rental_id") == [1, 2]


def test_staging_drops_impossible_stations(spark):
    bad = [station(2, lat=51.71), station(3, lon=0.31), station(4, docks=0), station(5, lat=None)]
    edge = [station(6, lat=51.3, lon=-0.6), station(7, lat=51.7, lon=0.3)]
    staged = build(spark, [], [station(1), *bad, *edge]).stg_stations
    assert column(staged, "station_id", "station_id") == [1, 6, 7]


def test_capacity_tiers(spark):
    stations = [station(i, docks=d) for i, d in enumerate([15, 16, 24, 25])]
    staged = build(spark, [], stations).stg_stations
    assert column(staged, "capacity_tier", "station_id") == ["small", "medium", "medium", "large"]


RIDES = [
    ride(1, "2024-01-02 07:30:00", 600, 1, 2),
    ride(2, "2024-01-02 09:30:00", 1200, 1, 2),
    ride(3, "2024-01-02 12:00:00", 1800, 2, 1),
    ride(4, "2024-01-02 18:00:00", 300, 1, None),
    ride(5, "2024-01-03 18:00:00", 300, 9, 3),  # station 9 is not known
    ride(6, "2024-01-05 18:00:00", 300, 1, 1),
]
STATIONS = [station(1, docks=10), station(2), station(3)]


def test_daily_flow(spark):
    daily = build(spark, RIDES, STATIONS).station_daily
    got = {(r.hire_date.day, r.station_id): r for r in daily.collect()}
    # Station 3 only receives a bike on the 3rd: a day without departures has no row.
    assert set(got) == {(2, 1), (2, 2), (3, 9), (5, 1)}
    first = got[2, 1]
    assert (first.total_departures, first.total_arrivals, first.net_flow) == (3, 1, 2)
    assert (first.peak_departures, first.peak_arrivals) == (2, 0)
    assert first.imbalance_score == pytest.approx(0.5) and first.is_imbalanced
    assert first.imbalance_direction == "draining"
    assert first.utilisation_rate == pytest.approx(4 / 20)
    assert first.avg_duration_mins == pytest.approx((10 + 20 + 5) / 3)
    assert got[2, 2].imbalance_direction == "filling"
    assert got[3, 9].zone is None and got[3, 9].utilisation_rate is None
    assert got[5, 1].imbalance_direction == "balanced" and not got[5, 1].is_imbalanced


def test_fact_defaults_for_unknown_stations(spark):
    fact = build(spark, RIDES, STATIONS).fact_rides
    orphan = fact.filter("rental_id = 5").first()
    assert orphan.start_zone is None and orphan.start_station_utilisation_rate == 0
    assert orphan.start_station_imbalance_score == 1.0
    assert fact.columns == marts.FACT_COLUMNS and fact.count() == len(RIDES)


def test_imbalanced_needs_more_than_a_fifth(spark):
    # 3 departures and 2 arrivals: score 0.2 exactly.
    rides = [ride(i, "2024-01-02 10:00:00", 600, 1, 1 if i < 2 else 2) for i in range(3)]
    row = build(spark, rides, STATIONS).station_daily.filter("station_id = 1").first()
    assert row.imbalance_score == pytest.approx(0.2) and not row.is_imbalanced


def test_rolling_mean_counts_rows_not_days(spark):
    days = [1, 2, 3, 10, 11, 12, 20, 21]
    rides, n = [], 0
    for position, day in enumerate(days, 1):
        for _ in range(position):
            n += 1
            rides.append(ride(n, f"2024-01-{day:02d} 10:00:00", 600, 1, 2))
    rolled = enrich.station_rolling(build(spark, rides, STATIONS).station_daily)
    got = column(rolled.filter("station_id = 1"), "rolling_7d_avg_departures", "hire_date")
    want = [sum(range(max(1, i - 6), i + 1)) / min(i, 7) for i in range(1, 9)]
    assert got == pytest.approx(want)


# One station under two names on a day: every ride meets both daily rows.
TWO_NAMES = [
    ride(1, "2024-01-02 10:00:00", 600, 1, 2, name="Old"),
    ride(2, "2024-01-02 11:00:00", 600, 1, 2, name="Old"),
    ride(3, "2024-01-02 12:00:00", 900, 1, 1, name="New"),
    ride(4, "2024-01-03 12:00:00", 900, None, 1),
    ride(5, "2024-01-03 12:00:00", 900, None, 2, name="Lost"),
]


def test_two_names_multiply_rides(spark):
    w = build(spark, TWO_NAMES, STATIONS)
    assert w.fact_rides.count() == 8
    results = quality.post_transform(w.fact_rides, w.dim_stations, w.dim_date, 1)
    status = {r.check_id: r.status for r in results.collect()}
    assert status["Q18"] == "FAIL"


def random_rides(n, seed=5):
    """Few stations, days and names, so that every kind of collision occurs."""
    pick = random.Random(seed)
    return [
        ride(
            i,
            f"2024-01-{pick.randint(1, 4):02d} {pick.randint(0, 23):02d}:00:00",
            pick.choice([30, 60, 700, 4000]),
            pick.choice([None, 1, 1, 1, 2, 9]),
            pick.choice([None, 1, 2, 3, 9]),
            name=pick.choice([None, "A", "B"]),
        )
        for i in range(n)
    ]


@pytest.mark.parametrize(
    "rides", [RIDES, TWO_NAMES, random_rides(300)], ids=["plain", "two names", "random"]
)
def test_counted_rides_equal_the_grouped_fact(spark, rides):
    w = build(spark, rides, STATIONS)
    grouped = enrich.station_day_rides_of_fact(w.fact_rides)
    names = grouped.columns
    folded = w.station_day_rides.groupBy(*[c for c in names if c not in ("n_rides", "n_peak", "sum_minutes")]).agg(
        F.sum("n_rides").alias("n_rides"), F.sum("n_peak").alias("n_peak"), F.sum("sum_minutes").alias("sum_minutes")
    )
    assert rows(folded.select(*names)) == rows(grouped)


def test_counted_rides_equal_the_grouped_fact_on_given_tables(spark):
    w = given(spark, SMALL)
    grouped = enrich.station_day_rides_of_fact(w.fact_rides)
    assert rows(w.station_day_rides.select(*grouped.columns)) == rows(grouped)


def test_date_dimension(spark):
    days = marts.dim_date(spark)
    assert days.count() == 4017
    last = days.orderBy(F.desc("full_date")).first()
    assert last.full_date == date(2025, 12, 30) and last.date_id == 20251230
    holiday = days.filter("full_date = DATE '2024-08-26'").first()
    assert holiday.is_uk_bank_holiday and holiday.bank_holiday_name == "Summer Bank Holiday"
    assert days.filter("is_uk_bank_holiday").count() == 16


@pytest.mark.parametrize(
    "folder, valid, days, stations, orphans",
    [(SMALL, 965, 177, 10, 0), (MEDIUM, 9612, 660, 98, 496)],
    ids=["0.001", "0.01"],
)
def test_measured_values_of_the_given_tables(spark, folder, valid, days, stations, orphans):
    w = given(spark, folder)
    assert w.stg_rides.count() == valid
    assert w.station_daily.count() == days
    assert w.stg_stations.count() == stations
    lost = quality.orphan_keys(w.stg_rides, "start_station_id", w.stg_stations, "station_id")
    assert (lost.agg(F.sum("rows")).first()[0] or 0) == orphans


def test_shuffled_joins_give_the_same_fact(spark):
    """Beyond the broadcast limits every join sorts and merges; a third of the rides share one key."""
    rides = [ride(i, "2024-01-02 10:00:00", 600 + i, 1 if i % 3 else i % 7, i % 5) for i in range(300)]
    w = build(spark, rides, STATIONS)
    small = rows(marts.fact_rides(w.rides_enriched, w.station_daily))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fact = marts.fact_rides(w.rides_enriched, w.station_daily)
        plan = fact._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
        assert rows(fact) == small
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_one_busy_station_is_split_over_tasks(spark):
    """A third of the rides start at one station; the sorted-merge plan splits its partition."""
    n = 30_000
    hot = F.pmod(F.xxhash64("id"), F.lit(3)) == 0
    rides = spark.range(0, n, 1, 8).select(
        F.col("id").alias("rental_id"),
        F.lit(600).cast("bigint").alias("duration"),
        F.lit(1).cast("bigint").alias("bike_id"),
        F.timestamp_seconds(F.lit(1704110400 + 600)).alias("end_date"),
        F.when(F.col("id") % 3 > 0, F.pmod(F.xxhash64("id"), F.lit(200))).alias("end_station_id"),
        F.sha2(F.col("id").cast("string"), 512).alias("end_station_name"),
        F.timestamp_seconds(F.lit(1704110400)).alias("start_date"),
        F.when(hot, 7).otherwise(F.pmod(F.col("id"), F.lit(200))).cast("bigint").alias("start_station_id"),
        F.lit("S").alias("start_station_name"),
    )
    stations = stations_frame(spark, [station(i) for i in range(200)])
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        enriched = Warehouse(rides, stations).rides_enriched
        # Names are read too, so that the rows have a size worth splitting.
        width = F.sum(F.length("end_station_name")).alias("width")
        got = enriched.groupBy("start_zone").agg(F.count(F.lit(1)).alias("n"), width)
        assert sum(r.n for r in got.collect()) == n
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin(skew=true)" in plan
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_publish_stores_checked_tables(spark):
    w = given(spark, SMALL)
    published = publish(w, sinks.fresh_path(spark, "publish"), PublishSettings(min_rows=900))
    assert rows(published.fact_rides) == rows(w.fact_rides)
    assert rows(published.dim_stations) == rows(w.dim_stations)
    assert {r.status for r in published.checks.collect()} <= {"PASS", "WARN"}


def test_publish_stops_at_a_failed_gate(spark):
    w = given(spark, SMALL)
    folder = sinks.fresh_path(spark, "publish")
    with pytest.raises(quality.QualityError, match="Q10"):
        publish(w, folder)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        published(spark, folder)


def test_a_failed_run_leaves_the_published_tables(spark):
    folder, settings = sinks.fresh_path(spark, "publish"), PublishSettings(min_rows=1)
    ok = [ride(i, "2024-01-02 10:00:00", 600 + i, 1, 2) for i in range(5)]
    publish(build(spark, ok, STATIONS), folder, settings)
    before = rows(published(spark, folder).fact_rides)
    two_names = [*ok, ride(9, "2024-01-02 11:00:00", 600, 1, 2, name="Other name")]
    with pytest.raises(quality.QualityError, match="D01"):
        publish(build(spark, two_names, STATIONS), folder, settings)
    assert rows(published(spark, folder).fact_rides) == before
    publish(build(spark, ok[:4], STATIONS), folder, settings)
    assert published(spark, folder).fact_rides.count() == 4


def test_views_serve_sql(spark):
    w = given(spark, SMALL)
    w.create_views()
    got = spark.sql("SELECT count(*) FROM fact_rides f JOIN dim_date d ON f.hire_date = d.full_date")
    assert got.first()[0] == w.stg_rides.count()


def test_schema_tests_are_complete():
    tests = schema_tests.STAGING_TESTS | schema_tests.MART_TESTS
    assert sum(len(listed) for listed in tests.values()) == 58


def test_published_tables_in_the_catalog(spark):
    w = given(spark, SMALL)
    folder = sinks.fresh_path(spark, "publish")
    publish(w, folder, PublishSettings(min_rows=900))
    names = catalog.register_run(spark, folder, POINTER, "checked")
    assert "checked.fact_rides" in names
    assert rows(spark.table("checked.fact_rides").select(*w.fact_rides.columns)) == rows(w.fact_rides)
    day = spark.sql("SELECT count(*) FROM checked.fact_rides WHERE hire_date = DATE '2024-01-05'")
    assert day.first()[0] == w.stg_rides.filter("hire_date = DATE '2024-01-05'").count()
    filled = {r["column_name"]: r["filled"] for r in catalog.described(spark, "checked.fact_rides").collect()}
    assert filled["rental_id"] == w.stg_rides.count() > filled["end_station_id"]
    before = rows(catalog.column_listing(spark, "checked.fact_rides"))
    assert {r[0]: r[1] for r in before} == {c: t for c, t in w.fact_rides.dtypes}
    sinks.remove(spark, folder)  # the listing reads no file
    assert rows(catalog.column_listing(spark, "checked.fact_rides")) == before
    assert "Scan" not in catalog.column_listing(spark, "checked.fact_rides")._jdf.queryExecution().optimizedPlan().toString()
    for name in names:
        spark.sql(f"DROP TABLE {name}")
