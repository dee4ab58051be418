"""Rides with attributes, and the station-by-day flow table.

No join carries a broadcast hint. Spark broadcasts the station list while its size is under
``spark.sql.autoBroadcastJoinThreshold``; above it the join sorts and merges, and adaptive
execution splits the partitions that one busy station overloads.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dockflow import constants as K
from dockflow.functions import calendar, rides as R, stations as S
from dockflow.functions.numeric import ratio

STATION_ROLE_COLUMNS = {
    "zone": "zone",
    "nb_docks": "nb_docks",
    "capacity_tier": "capacity_tier",
    "latitude": "lat",
    "longitude": "lon",
}

DAILY_COLUMNS = [
    "hire_date",
    "station_id",
    "station_name",
    "zone",
    "nb_docks",
    "latitude",
    "longitude",
    "total_departures",
    "total_arrivals",
    "peak_departures",
    "peak_arrivals",
    "avg_duration_mins",
    "net_flow",
    "utilisation_rate",
    "imbalance_score",
    "is_imbalanced",
    "imbalance_direction",
]


def banded_rides(staged: DataFrame) -> DataFrame:
    """Staged rides with every attribute that needs no station: reports on these never join."""
    return staged.withColumns(
        {
            "duration_minutes": R.duration_minutes(F.col("duration_seconds")),
            "duration_band": R.duration_band(F.col("duration_seconds")),
            "peak_hour_flag": calendar.peak_flag(F.col("start_hour")),
            "time_period": calendar.time_period(F.col("start_hour")),
            "is_round_trip": R.is_round_trip(F.col("start_station_id"), F.col("end_station_id")),
        }
    )


def _as_role(stations: DataFrame, role: str) -> DataFrame:
    attributes = [F.col(c).alias(f"{role}_{out}") for c, out in STATION_ROLE_COLUMNS.items()]
    return stations.select(F.col("station_id").alias(f"{role}_ref"), *attributes)


def rides_enriched(banded: DataFrame, stations: DataFrame) -> DataFrame:
    """Banded rides with the attributes of both stations; unknown stations stay NULL."""
    start, end = _as_role(stations, "start"), _as_role(stations, "end")
    joined = banded.join(start, F.col("start_station_id") == F.col("start_ref"), "left").join(
        end, F.col("end_station_id") == F.col("end_ref"), "left"
    )
    return joined.select(
        "rental_id",
        "bike_id",
        "start_datetime",
        "end_datetime",
        "hire_date",
        "start_hour",
        "day_of_week",
        "is_weekend",
        "duration_seconds",
        "duration_minutes",
        "duration_band",
        "peak_hour_flag",
        "time_period",
        "start_station_id",
        "start_station_name",
        "start_zone",
        "start_nb_docks",
        "start_capacity_tier",
        "start_lat",
        "start_lon",
        "end_station_id",
        "end_station_name",
        "end_zone",
        "end_nb_docks",
        "end_capacity_tier",
        "end_lat",
        "end_lon",
        "is_round_trip",
    )


def both_ends(rides: DataFrame, keep: list[str], start_only: dict[str, str] | None = None) -> DataFrame:
    """One row per ride end: (keep…, station_id, is_departure, start_only…).

    A single scan feeds departures and arrivals. ``start_only`` maps output names to ride columns
    that describe the start; they are NULL on arrivals.
    """
    start_only = start_only or {}
    extras = ", ".join(start_only.values())
    nulls = ", ".join(["NULL"] * len(start_only))
    names = ", ".join(["station_id", "is_departure", *start_only])
    departure = ", ".join(filter(None, ["start_station_id", "true", extras]))
    arrival = ", ".join(filter(None, ["end_station_id", "false", nulls]))
    return rides.selectExpr(*keep, f"stack(2, {departure}, {arrival}) AS ({names})")


def _station_days(banded: DataFrame) -> DataFrame:
    """Departures per (day, station, name) with the arrivals of the same (day, station)."""
    ends = both_ends(
        banded,
        ["hire_date", "peak_hour_flag"],
        {"station_name": "start_station_name", "minutes": "duration_minutes"},
    )
    # An arrival without a station can never match a departure.
    known = ends.filter(F.col("is_departure") | F.col("station_id").isNotNull())
    counted = known.groupBy("hire_date", "station_id", "station_name", "is_departure").agg(
        F.count(F.lit(1)).alias("moves"),
        F.count_if(F.col("peak_hour_flag") == 1).alias("peak_moves"),
        F.sum("minutes").alias("sum_minutes"),
    )
    # Already one row per station, name and direction of a day: these groups are tiny.
    same_day = Window.partitionBy("hire_date", "station_id")
    arrived = F.when(~F.col("is_departure"), F.col("moves"))
    arrived_peak = F.when(~F.col("is_departure"), F.col("peak_moves"))
    return (
        counted.withColumns(
            {
                "total_arrivals": F.coalesce(F.sum(arrived).over(same_day), F.lit(0)),
                "peak_arrivals": F.coalesce(F.sum(arrived_peak).over(same_day), F.lit(0)),
            }
        )
        .filter("is_departure")
        .withColumnsRenamed({"moves": "total_departures", "peak_moves": "peak_departures"})
    )


def _station_flow_days(banded: DataFrame, stations: DataFrame) -> DataFrame:
    """All columns of the daily table plus ``sum_minutes``, one row per departure group."""
    places = stations.select(
        F.col("station_id").alias("place_id"), "zone", "nb_docks", "latitude", "longitude"
    )
    days = _station_days(banded)
    joined = days.join(places, days.station_id == places.place_id, "left")
    dep, arr = F.col("total_departures"), F.col("total_arrivals")
    return joined.withColumns(
        {
            "avg_duration_mins": F.coalesce(ratio(F.col("sum_minutes"), dep), F.lit(0.0)),
            "net_flow": dep - arr,
            "utilisation_rate": ratio(dep + arr, F.col("nb_docks") * 2.0),
            "imbalance_score": S.imbalance_score(dep, arr),
        }
    ).withColumns(
        {
            "is_imbalanced": F.coalesce(F.col("imbalance_score") > K.IMBALANCED_ABOVE, F.lit(False)),
            "imbalance_direction": S.direction(F.col("net_flow")),
        }
    )


def station_daily_stats(banded: DataFrame, stations: DataFrame) -> DataFrame:
    """Flow of every station and day that saw a departure.

    Stations are looked up after counting, once per station-day. That equals looking them up per
    ride as long as station ids are unique, which the first quality gate demands.
    """
    return _station_flow_days(banded, stations).select(*DAILY_COLUMNS)


def station_rolling(daily: DataFrame) -> DataFrame:
    """Mean departures over a station's last seven active days (rows, not calendar days; two names of a day by name)."""
    last_rows = Window.partitionBy("station_id").orderBy("hire_date", "station_name").rowsBetween(-6, 0)
    return daily.withColumn("rolling_7d_avg_departures", F.avg("total_departures").over(last_rows))


SIGNALS = {
    "imbalance_score": ("start_station_imbalance_score", 0.0),
    "is_imbalanced": ("start_station_is_imbalanced", False),
    "imbalance_direction": ("start_station_imbalance_direction", "balanced"),
    "net_flow": ("start_station_net_flow", 0),
    "utilisation_rate": ("start_station_utilisation_rate", 0.0),
    "rolling_7d_avg_departures": ("start_station_rolling_7d_avg", 0.0),
}


def station_day_rides(banded: DataFrame, stations: DataFrame) -> DataFrame:
    """The ride fact counted by day, start station and signal: the input of the station reports.

    Same figures as grouping the fact itself, but rides are counted before any join, so nothing of
    ride size is shuffled. Rows: ``n_rides``, ``n_peak`` and ``sum_minutes`` per group. A station
    seen under two names on one day pairs every name with every signal row, as in the fact.
    """
    days = _station_flow_days(banded, stations)
    same_day = Window.partitionBy("hire_date", "station_id")
    picked = [c for c in SIGNALS if c != "rolling_7d_avg_departures"]
    signal = F.struct(*picked)
    own = F.when(F.col("station_id").isNotNull(), F.collect_list(signal).over(same_day))
    paired = days.withColumn("own", own).select(
        "hire_date",
        F.col("station_id").alias("start_station_id"),
        F.col("station_name").alias("start_station_name"),
        F.col("zone").alias("start_zone"),
        F.col("nb_docks").alias("start_nb_docks"),
        F.col("latitude").alias("start_lat"),
        F.col("longitude").alias("start_lon"),
        F.col("total_departures").alias("n_rides"),
        F.col("peak_departures").alias("n_peak"),
        "sum_minutes",
        F.explode_outer("own").alias("signal"),
    )
    signals = [
        F.coalesce(F.col(f"signal.{c}"), F.lit(SIGNALS[c][1])).alias(SIGNALS[c][0]) for c in picked
    ]
    return paired.select(*[c for c in paired.columns if c != "signal"], *signals)


def station_day_rides_of_fact(fact: DataFrame) -> DataFrame:
    """The same counts taken from a stored fact table."""
    signal_names = [out for c, (out, _) in SIGNALS.items() if c != "rolling_7d_avg_departures"]
    keys = [
        "hire_date",
        "start_station_id",
        "start_station_name",
        "start_zone",
        "start_nb_docks",
        "start_lat",
        "start_lon",
    ]
    counted = fact.groupBy(*keys, *signal_names).agg(
        F.count(F.lit(1)).alias("n_rides"),
        F.count_if(F.col("peak_hour_flag") == 1).alias("n_peak"),
        F.sum("duration_minutes").alias("sum_minutes"),
    )
    return counted.select(*keys, "n_rides", "n_peak", "sum_minutes", *signal_names)
