"""Flow and exploration against pandas brute force."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from dockflow.operators import explore, flow
from dockflow.sources import testdata
from tests.conftest import SMALL
from tests.frames import ride, rides_frame, rows, station, stations_frame


@pytest.fixture(scope="module")
def raw(spark):
    frame = testdata.cycle_hire(spark, SMALL).persist()
    yield frame
    frame.unpersist()


@pytest.fixture(scope="module")
def places(spark):
    frame = testdata.cycle_stations(spark, SMALL).persist()
    yield frame
    frame.unpersist()


@pytest.fixture(scope="module")
def pandas_rides(raw):
    return raw.toPandas()


def brute_flow(rides, keys=()):
    keys = list(keys)
    dep = rides.groupby(keys + ["start_station_id"]).size().rename("departures")
    arr = rides.groupby(keys + ["end_station_id"]).size().rename("arrivals")
    dep.index = dep.index.set_names(keys + ["sid"])
    arr.index = arr.index.set_names(keys + ["sid"])
    both = pd.concat([dep, arr], axis=1).fillna(0).reset_index()
    both["net"] = both.departures - both.arrivals
    both["score"] = both.net.abs() / (both.departures + both.arrivals).clip(lower=1)
    return both


def test_station_flow(spark, raw, places, pandas_rides):
    want = brute_flow(pandas_rides)
    got = flow.station_flow(raw, places)
    assert rows(got.select("start_station_id", "departures", "arrivals", "net_flow", "imb_score")) == sorted(
        [(int(r.sid), int(r.departures), int(r.arrivals), int(r.net), round(r.score, 6)) for r in want.itertuples()],
        key=lambda t: tuple((v is None, str(v)) for v in t),
    )


def test_day_flow_keeps_arrival_only_days(raw, pandas_rides):
    rides = pandas_rides.assign(day=pandas_rides.start_date.dt.date)
    want = brute_flow(rides, ["day"])
    days = flow.station_day_flow(raw)
    assert days.count() == len(want) == 188
    share = flow.imbalanced_station_days(days).first()
    assert share.imbalanced_days == int((want.score > 0.2).sum())
    network = want.groupby("day").score.mean()
    got = flow.network_daily_imbalance(days).collect()
    assert [r.hire_date for r in got] == list(network.index)
    assert [r.imb_score for r in got] == pytest.approx(list(network))
    assert flow.network_mean_imbalance(days).first()[0] == pytest.approx(network.mean())


def test_flow_of_unknown_and_unused_stations(spark):
    rides = rides_frame(spark, [ride(1, "2024-01-01 08:00:00", 60, 1, 7), ride(2, "2024-01-01 08:00:00", 60, 1, None)])
    stations = stations_frame(spark, [station(1), station(2)])
    table = {r.start_station_id: r for r in flow.station_flow(rides, stations).collect()}
    assert set(table) == {1, 7} and table[7].station_name is None and table[1].net_flow == 2
    on_map = {r.id: r for r in flow.station_flow_map(rides, stations).collect()}
    assert set(on_map) == {1, 2}
    assert (on_map[2].imb_direction, on_map[2].total_moves, on_map[2].priority) == ("balanced", None, "LOW")
    zones = {r.zone: r.stations for r in flow.zone_imbalance(flow.station_flow(rides, stations)).collect()}
    assert sum(zones.values()) == 2 and zones["Other"] == 1


def test_period_hotspots(spark):
    rides = rides_frame(
        spark,
        [
            ride(1, "2024-01-01 07:00:00", 60, 1, 2),
            ride(2, "2024-01-01 09:59:00", 60, 1, 2),
            ride(3, "2024-01-01 10:00:00", 60, 1, 2),
            ride(4, "2024-01-01 17:00:00", 60, 2, 1),
            ride(5, "2024-01-01 19:59:00", 60, 2, 9),
        ],
    )
    stations = stations_frame(spark, [station(1, name="A" * 40), station(2)])
    got = flow.period_hotspots(flow.period_flow(rides), stations, n=1).collect()
    assert [(r.period[:2], r.station_id, r.net_flow, r.bikes) for r in got] == [("AM", 1, 2, 2), ("PM", 1, -1, 1)]
    assert got[0].station_name == "A" * 40


def explored_pandas(rides):
    out = rides.copy()
    out["m"] = out.duration / 60
    out["weekend"] = out.start_date.dt.dayofweek >= 5
    out["hour"] = out.start_date.dt.hour
    out["peak"] = out.hour.isin([7, 8, 17, 18]).astype(int)
    return out


def test_ride_summary(raw, pandas_rides):
    p = explored_pandas(pandas_rides)
    got = explore.ride_summary(explore.explored(raw)).first()
    assert got.total_rides == len(p)
    assert got.unique_stations == p.start_station_id.nunique() and got.unique_bikes == p.bike_id.nunique()
    want = [p.m.mean(), p.m.median(), p.m.min(), p.m.max(), p.m.sum() / 60, p.peak.mean() * 100, p.weekend.mean() * 100]
    names = ["avg_minutes", "median_minutes", "min_minutes", "max_minutes", "total_hours", "peak_pct", "weekend_pct"]
    assert [got[n] for n in names] == pytest.approx(want)


def test_median_of_an_even_count_interpolates(spark):
    rides = rides_frame(spark, [ride(i, "2024-01-01 10:00:00", s, 1, 1) for i, s in enumerate([60, 120, 300, 600])])
    assert explore.ride_summary(explore.explored(rides)).first().median_minutes == 3.5


def test_hourly_profile_sums_to_hundred_per_group(raw, pandas_rides):
    profile = explore.hourly_profile(explore.explored(raw), "is_weekend")
    totals = profile.groupBy("is_weekend").agg(F.sum("pct").alias("t")).collect()
    assert [r.t for r in totals] == pytest.approx([100.0, 100.0])
    p = explored_pandas(pandas_rides)
    want = p[~p.weekend].groupby("hour").size()
    got = {r.start_hour: r.pct for r in profile.filter("NOT is_weekend").collect()}
    assert got == pytest.approx((want / want.sum() * 100).to_dict())


def test_histograms_match_numpy(raw, pandas_rides):
    p = explored_pandas(pandas_rides)
    got = explore.duration_histogram(explore.explored(raw)).collect()
    series = {
        "all": (p.m, 80),
        "weekday": (p.m[~p.weekend].clip(upper=90), 40),
        "weekend": (p.m[p.weekend].clip(upper=90), 40),
    }
    for name, (data, bins) in series.items():
        counts, edges = np.histogram(data, bins=bins)
        density, _ = np.histogram(data, bins=bins, density=True)
        mine = sorted((r.bin, r.n, r.bin_low, r.density) for r in got if r.series == name)
        assert [m[1] for m in mine] == list(counts)
        assert [m[2] for m in mine] == pytest.approx(list(edges[:-1]))
        assert [m[3] for m in mine] == pytest.approx(list(density))


def test_absent_days_show_zero(spark):
    rides = rides_frame(spark, [ride(1, "2024-01-06 10:00:00", 600, 1, 1)])  # a Saturday
    got = explore.dow_counts(explore.explored(rides)).collect()
    assert [r.rides for r in got] == [0, 0, 0, 0, 0, 1, 0] and got[0].day_name == "Monday"
    pivot = explore.dow_hour_pivot(explore.explored(rides)).first()
    assert pivot.h10 == 1 and sum(pivot[f"h{h:02d}"] for h in range(24)) == 1


def test_column_profile_matches_pandas(spark, raw, pandas_rides):
    got = {r.column_name: (r.nulls, r.unique_values, r.dtype) for r in explore.column_profile(raw).collect()}
    want = {c: (pandas_rides[c].isna().sum(), pandas_rides[c].nunique()) for c in pandas_rides}
    assert {c: v[:2] for c, v in got.items()} == want
    assert got["start_date"][2] == "timestamp"
    zeros = spark.createDataFrame([(0.0,), (-0.0,), (None,)], "x double")
    assert tuple(explore.column_profile(zeros).first()) == ("x", "double", 1, 1)
