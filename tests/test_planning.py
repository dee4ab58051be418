from pyspark.sql import functions as F

from dockflow.operators import forecast, planning, stations, trends
from dockflow.plans.warehouse import Warehouse
from dockflow.sources import testdata
from parity import registry
from tests.conftest import MEDIUM
from tests.frames import rows

SCHEMA = (
    "station string, zone string, lat double, lon double, nb_docks bigint, imb_score double, "
    "net_flow double, imb_direction string, total_rides bigint, action string, priority string"
)


def listing(spark, items):
    rows_ = [
        (name, "Other", 51.5, -0.1 - i / 1000, 20 if i else None, score, flow, "draining", 60, action, priority)
        for i, (name, score, flow, action, priority) in enumerate(items)
    ]
    return spark.createDataFrame(rows_, SCHEMA)


DELIVER, COLLECT, MONITOR = "DELIVER BIKES", "COLLECT BIKES", "MONITOR"


def test_dispatch_list_is_ranked_and_filtered(spark):
    plan = listing(
        spark,
        [("a", 0.3, 2.7, DELIVER, "CRITICAL"), ("b", 0.4, -3.9, COLLECT, "CRITICAL"),
         ("c", 0.9, 0.5, MONITOR, "CRITICAL"), ("d", 0.15, 4.0, DELIVER, "MEDIUM")],
    )
    got = planning.dispatch_list(plan).collect()
    assert [(r.station, r.bikes_per_day, r.docks) for r in got] == [("b", -3, 20), ("a", 2, 0)]


def test_crew_runs_round_half_to_even_and_are_at_least_one(spark):
    def runs(n):
        plan = listing(spark, [(f"s{i}", 0.3, 5.0, DELIVER, "HIGH") for i in range(n)])
        return planning.crew_plan(plan, plan).filter("plan = 'scenario'").first().crew_runs

    assert [runs(n) for n in (0, 1, 15, 22, 23, 38)] == [1, 1, 1, 1, 2, 3]


def test_action_statement_tiers(spark):
    def tier(score):
        got = planning.action_statement(listing(spark, [("a", score, 5.0, DELIVER, "HIGH")])).first()
        return got.urgency, got.within_hours

    assert [tier(s) for s in (0.40, 0.39, 0.25, 0.24)] == [
        ("immediately", 2), ("urgently", 4), ("urgently", 4), ("today", 6)]
    calm = planning.action_statement(listing(spark, [("a", 0.1, 0.0, MONITOR, "LOW")])).first()
    assert (calm.stations, calm.urgency, calm.within_hours) == (0, "all clear", None)


def test_danger_zone_falls_back_to_the_first_stations(spark):
    calm = listing(spark, [(f"s{i:02d}", i / 1000, 0.0, MONITOR, "LOW") for i in range(30)])
    assert planning.danger_zone(calm).filter("is_fallback").count() == 20
    mixed = calm.union(listing(spark, [("x", 0.2, 5.0, DELIVER, "HIGH")]))
    assert [(r.station, r.is_fallback) for r in planning.danger_zone(mixed).collect()] == [("x", False)]
    empty = planning.map_centre(calm.filter("false")).first()
    assert tuple(empty) == planning.DEFAULT_CENTRE


def test_recommendation_wraps_around_midnight(spark):
    plan = listing(spark, [("a", 0.3, 2.5, DELIVER, "HIGH"), ("b", 0.3, -0.2, COLLECT, "HIGH"), ("c", 0.0, 0.0, MONITOR, "LOW")])
    at = lambda hour: {r.station: r for r in planning.dispatch_recommendation(plan, hour).collect()}
    assert {s: r.hours_to_peak for s, r in at(22).items()} == {"a": 9, "b": 9}
    assert at(22)["a"].dispatch_window == 8 and at(7)["a"].dispatch_window == 1
    assert at(5)["a"].bikes_needed == 2 and at(5)["b"].bikes_needed == 1
    assert at(5)["a"].next_peak_label == "07:00"


def test_station_at_point_agrees_to_four_decimals(spark):
    plan = listing(spark, [("a", 0.3, 2.5, DELIVER, "HIGH"), ("b", 0.3, 2.5, DELIVER, "HIGH")])
    got = planning.station_at_point(plan, 51.50003, -0.10104)
    assert [r.station for r in got.collect()] == ["b"]


def test_lists_from_counts_and_from_a_fact_agree(spark):
    from dockflow.plans.enrich import station_day_rides_of_fact

    w = Warehouse(testdata.cycle_hire(spark, MEDIUM), testdata.cycle_stations(spark, MEDIUM))
    direct = stations.scenario_list(w.station_day_rides, *registry.DATES, 10)
    stored = stations.scenario_list(station_day_rides_of_fact(w.fact_rides), *registry.DATES, 10)
    assert rows(direct) == rows(stored) and direct.count() > 0


def test_windows_return_every_ride(spark):
    w = Warehouse(testdata.cycle_hire(spark, MEDIUM), testdata.cycle_stations(spark, MEDIUM))
    window = w.banded_rides.filter("hire_date >= '2024-01-15'")
    assert trends.recent_rides(w.banded_rides, "2024-01-20", days=5).count() == window.count()
    lasting = w.banded_rides.filter("duration_minutes BETWEEN 1 AND 120")
    assert trends.duration_sample(w.banded_rides, *registry.DATES).count() == lasting.count()


def test_fallback_forecast_covers_every_station_and_hour(spark):
    w = Warehouse(testdata.cycle_hire(spark, MEDIUM), testdata.cycle_stations(spark, MEDIUM))
    hours = forecast.fallback_forecast(w.stg_stations, w.banded_rides)
    assert hours.count() == w.stg_stations.count() * 24
    assert hours.filter("forecast < 0 OR lower_ci > forecast OR upper_ci < forecast").count() == 0
    totals = forecast.forecast_totals(hours)
    wrong = F.abs(F.col("total_24h") - F.col("peak_total") - F.col("offpeak_total")) > 1e-6
    assert totals.filter(wrong | (F.col("next_peak_hour") != 7)).count() == 0
