from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from dockflow import constants as K
from dockflow.functions import calendar, rides as R, stations as S
from dockflow.functions.numeric import half_even
from tests.frames import column, values


def evaluate(spark, name, kind, items, expression):
    return column(values(spark, name, kind, items).withColumn("out", expression), "out", "i")


def test_duration_band_edges(spark):
    got = evaluate(
        spark, "s", "bigint", [599, 600, 1799, 1800, 3599, 3600], R.duration_band(F.col("s"))
    )
    assert got == ["short", "medium", "medium", "long", "long", "extended"]


def test_eda_band_is_right_closed_and_bounded(spark):
    minutes = [0.0, 0.5, 10.0, 10.01, 30.0, 60.0, 60.5, 1440.0, 1440.5, None]
    got = evaluate(spark, "m", "double", minutes, R.eda_band(F.col("m")))
    short, medium, long, extended = (label for label, _, _ in K.EDA_BANDS)
    assert got == [None, short, short, medium, medium, long, extended, extended, None, None]


def test_hours(spark):
    hours = [6, 7, 8, 9, 10, 16, 17, 18, 19, 20, 23, 0]
    frame = values(spark, "h", "bigint", hours)
    periods = column(frame.withColumn("out", calendar.time_period(F.col("h"))), "out", "i")
    assert periods == ["night"] + ["am_peak"] * 3 + ["midday"] * 2 + ["pm_peak"] * 3 + [
        "evening",
        "evening",
        "night",
    ]
    flags = column(frame.withColumn("out", calendar.peak_flag(F.col("h"))), "out", "i")
    assert flags == [0, 1, 1, 0, 0, 0, 1, 1, 0, 0, 0, 0]


def test_week_number_counts_from_the_first_sunday(spark):
    days = [date(2016, 1, 1), date(2016, 1, 3), date(2017, 1, 1), date(2024, 12, 31)]
    got = evaluate(spark, "d", "date", days, calendar.week_number(F.col("d")))
    assert got == [int(d.strftime("%U")) for d in days] == [0, 1, 1, 52]


def test_weekday_conventions(spark):
    moments = [datetime(2024, 1, 5 + i, 12) for i in range(4)]  # Friday to Monday
    frame = values(spark, "t", "timestamp", moments)
    assert column(frame.withColumn("o", calendar.day_of_week(F.col("t"))), "o", "i") == [6, 7, 1, 2]
    assert column(frame.withColumn("o", calendar.monday_day(F.col("t"))), "o", "i") == [4, 5, 6, 0]
    weekend = column(frame.withColumn("o", calendar.is_weekend(F.col("t"))), "o", "i")
    assert weekend == [False, True, True, False]


def test_seasons(spark):
    days = [date(2023, m, 15) for m in range(1, 13)]
    codes = evaluate(spark, "d", "date", days, calendar.season_code(F.col("d")))
    assert codes == [0, 0, 1, 1, 1, 2, 2, 2, 3, 3, 3, 0]
    names = evaluate(spark, "d", "date", days, calendar.season_name(F.col("d")))
    assert names == [K.SEASONS[c] for c in codes]


def test_zone_corners_and_first_match(spark):
    points = []
    for name, lat_lo, lat_hi, lon_lo, lon_hi in K.ZONE_BOXES:
        points += [(lat_lo, lon_lo), (lat_hi, lon_hi), (lat_lo, lon_hi), (lat_hi, lon_lo)]
    points += [(51.0, 0.0), (None, -0.1), (51.51, None)]

    def expected(lat, lon):
        for name, lat_lo, lat_hi, lon_lo, lon_hi in K.ZONE_BOXES:
            if lat is not None and lon is not None and lat_lo <= lat <= lat_hi and lon_lo <= lon <= lon_hi:
                return name
        return "Other"

    rows = [(i, *p) for i, p in enumerate(points)]
    frame = spark.createDataFrame(rows, "i int, la double, lo double")
    got = column(frame.withColumn("zone", S.zone_of("la", "lo")), "zone", "i")
    assert got == [expected(*p) for p in points]
    # A shared edge belongs to the earlier box.
    assert expected(51.5, -0.115) == "Westminster & Victoria"


@pytest.mark.parametrize(
    "policy, at_edges",
    [
        ("mart", ["LOW", "MEDIUM", "HIGH", "CRITICAL"]),
        ("ops", ["LOW", "LOW", "MEDIUM", "HIGH"]),
    ],
)
def test_priority_owns_its_edges(spark, policy, at_edges):
    scores = [0.0999, 0.10, 0.18, 0.25]
    assert evaluate(spark, "s", "double", scores, S.priority(F.col("s"), policy)) == at_edges
    above = evaluate(spark, "s", "double", [0.1001, 0.1801, 0.2501], S.priority(F.col("s"), policy))
    assert above == ["MEDIUM", "HIGH", "CRITICAL"]


def test_legacy_priority(spark):
    scores = [0.0, 0.1, 0.3, 0.5, 0.51, 1.0, 1.02, None]
    got = evaluate(spark, "s", "double", scores, S.priority(F.col("s"), "legacy"))
    assert got == ["LOW", "LOW", "MEDIUM", "HIGH", "CRITICAL", "CRITICAL", "nan", "nan"]


def test_action_dead_band(spark):
    flows = [-2.1, -2.0, -0.1, 0.0, 0.1, 2.0, 2.1]
    wide = evaluate(spark, "n", "double", flows, S.action(F.col("n"), 2.0))
    assert wide == ["COLLECT BIKES"] + ["MONITOR"] * 5 + ["DELIVER BIKES"]
    none = evaluate(spark, "n", "double", flows, S.action(F.col("n"), 0.0))
    assert none == ["COLLECT BIKES"] * 3 + ["MONITOR"] + ["DELIVER BIKES"] * 3


def test_imbalance_score(spark):
    rows = [(0, 0, 0), (1, 3, 1), (2, 0, 4), (3, 5, 0)]
    frame = spark.createDataFrame(rows, "i int, d bigint, a bigint")
    got = column(frame.withColumn("s", S.imbalance_score(F.col("d"), F.col("a"))), "s", "i")
    assert got == [0.0, 0.5, 1.0, 1.0]


def test_half_even(spark):
    got = evaluate(spark, "v", "double", [0.5, 1.5, 2.5, -0.5, 2.4], half_even(F.col("v")))
    assert got == [0.0, 2.0, 2.0, 0.0, 2.0]


def test_colours(spark):
    got = evaluate(spark, "s", "double", [0.05, 0.1, 0.3, 0.5], S.map_colour(F.col("s"), 0))
    assert got == [c[1] for c in K.MAP_COLOURS] + [K.MAP_COLOUR_ELSE[0]]
    got = evaluate(spark, "s", "double", [0.25, 0.18, 0.10, 0.09], S.scenario_colour(F.col("s")))
    assert got == [c for _, c in K.SCENARIO_COLOURS] + [K.SCENARIO_COLOUR_ELSE]


def test_surrogate_key_has_a_text_for_null(spark):
    import hashlib

    frame = spark.createDataFrame([(0, 7, None)], "i int, a bigint, b string")
    one = column(frame.withColumn("k", R.surrogate_key(F.col("a"))), "k", "i")
    two = column(frame.withColumn("k", R.surrogate_key(F.col("a"), F.col("b"))), "k", "i")
    assert one == [hashlib.md5(b"7").hexdigest()]
    assert two == [hashlib.md5(f"7-{K.NULL_KEY_TEXT}".encode()).hexdigest()]


def test_round_trip(spark):
    frame = spark.createDataFrame([(0, 1, 1), (1, 1, 2), (2, 1, None), (3, None, None)], "i int, a int, b int")
    got = column(frame.withColumn("r", R.is_round_trip(F.col("a"), F.col("b"))), "r", "i")
    assert got == [True, False, False, False]
