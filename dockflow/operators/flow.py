"""Departures against arrivals straight from raw rides: the full outer view of station flow.

Both sides come from one scan: each ride gives a departure row and an arrival row, and partial
aggregation shrinks them to one row per station (and day) before the only shuffle.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockflow import constants as K
from dockflow.functions import calendar, stations as S
from dockflow.functions.numeric import percent
from dockflow.plans.enrich import both_ends

TITLE_DIRECTIONS = ("Draining", "Filling", "Balanced")


def with_day(raw: DataFrame) -> DataFrame:
    return raw.withColumn("hire_date", F.to_date("start_date"))


def count_ends(rides: DataFrame, keys: list[str]) -> DataFrame:
    """Departures and arrivals by the keys and station; ends without a station are left out."""
    return (
        both_ends(rides, keys)
        .filter(F.col("station_id").isNotNull())
        .groupBy(*keys, "station_id")
        .agg(
            F.count_if("is_departure").alias("departures"),
            F.count_if(~F.col("is_departure")).alias("arrivals"),
        )
        .withColumn("net_flow", F.col("departures") - F.col("arrivals"))
    )


def _score() -> Column:
    return S.imbalance_score(F.col("departures"), F.col("arrivals"))


def station_day_flow(raw: DataFrame) -> DataFrame:
    """Every station and day with a departure or an arrival."""
    return count_ends(with_day(raw), ["hire_date"]).withColumn("imb_score", _score())


def imbalanced_station_days(days: DataFrame) -> DataFrame:
    over = F.col("imb_score") > K.IMBALANCED_ABOVE
    return days.agg(
        F.count(F.lit(1)).alias("station_days"),
        F.count_if(over).alias("imbalanced_days"),
        percent(F.count_if(over), F.count(F.lit(1))).alias("imbalanced_pct"),
    )


def network_daily_imbalance(days: DataFrame) -> DataFrame:
    return (
        days.groupBy("hire_date")
        .agg(F.avg("imb_score").alias("imb_score"), F.count(F.lit(1)).alias("station_days"))
        .orderBy("hire_date")
    )


def network_mean_imbalance(days: DataFrame) -> DataFrame:
    """The mean line of the daily trend: each day weighs the same."""
    return network_daily_imbalance(days).agg(F.avg("imb_score").alias("mean_imb_score"))


def _scored(flow: DataFrame) -> DataFrame:
    return flow.withColumns(
        {"total_moves": F.col("departures") + F.col("arrivals"), "imb_score": _score()}
    )


def station_flow(raw_rides: DataFrame, raw_stations: DataFrame) -> DataFrame:
    """All-time flow per station seen in a ride, with the legacy priority."""
    flow = _scored(count_ends(raw_rides, []))
    places = raw_stations.select(
        F.col("id").alias("place_id"),
        F.col("name").alias("station_name"),
        "docks_count",
        "latitude",
        "longitude",
    )
    return flow.join(places, flow.station_id == places.place_id, "left").select(
        F.col("station_id").alias("start_station_id"),
        "departures",
        "arrivals",
        "station_name",
        "docks_count",
        "latitude",
        "longitude",
        "net_flow",
        "total_moves",
        "imb_score",
        S.direction(F.col("net_flow"), TITLE_DIRECTIONS).alias("direction"),
        S.priority(F.col("imb_score"), "legacy").alias("priority"),
    )


def _all_stations(raw_rides: DataFrame, raw_stations: DataFrame) -> DataFrame:
    flow = _scored(count_ends(raw_rides, []))
    return raw_stations.join(flow, raw_stations.id == flow.station_id, "left").drop("station_id")


def station_flow_map(raw_rides: DataFrame, raw_stations: DataFrame) -> DataFrame:
    """Every station with its flow; a station without rides is balanced. ``total_moves`` stays NULL."""
    filled = _all_stations(raw_rides, raw_stations).fillna(
        {"imb_score": 0.0, "departures": 0, "arrivals": 0, "net_flow": 0}
    )
    return filled.select(
        "id",
        "name",
        "latitude",
        "longitude",
        "docks_count",
        "departures",
        "arrivals",
        "net_flow",
        "total_moves",
        "imb_score",
        S.direction(F.col("net_flow")).alias("imb_direction"),
        S.priority(F.col("imb_score"), "legacy").alias("priority"),
    )


def station_flow_list(
    raw_rides: DataFrame, raw_stations: DataFrame, dead_band: float = 2.0
) -> DataFrame:
    """The dispatch list taken from all-time raw flow, with the operations priority."""
    filled = _all_stations(raw_rides, raw_stations).fillna(
        {"imb_score": 0.0, "departures": 0, "arrivals": 0, "net_flow": 0, "total_moves": 0}
    )
    return filled.select(
        F.col("name").alias("station"),
        F.col("latitude").alias("lat"),
        F.col("longitude").alias("lon"),
        F.col("docks_count").alias("nb_docks"),
        "departures",
        "arrivals",
        "net_flow",
        F.col("total_moves").alias("total"),
        "imb_score",
        S.action(F.col("net_flow"), dead_band).alias("action"),
        S.priority(F.col("imb_score"), "ops").alias("priority"),
    ).orderBy(F.desc("imb_score"), "station")


def priority_counts(flow: DataFrame) -> DataFrame:
    """Stations per priority and per direction."""
    labels = flow.selectExpr(
        "stack(2, 'priority', priority, 'direction', direction) AS (kind, label)"
    )
    return labels.groupBy("kind", "label").agg(F.count(F.lit(1)).alias("stations"))


def zone_imbalance(flow: DataFrame) -> DataFrame:
    zone = S.zone_of("latitude", "longitude")
    return (
        flow.groupBy(zone.alias("zone"))
        .agg(
            F.count("start_station_id").alias("stations"),
            F.round(F.avg("imb_score"), 3).alias("avg_imbalance"),
            F.count_if(F.col("priority") == "CRITICAL").alias("critical_count"),
            F.count_if(F.col("direction") == TITLE_DIRECTIONS[0]).alias("draining_count"),
        )
        .orderBy(F.desc("avg_imbalance"), "zone")
    )


def top_imbalanced(flow: DataFrame, n: int = 20) -> DataFrame:
    top = flow.orderBy(F.desc("imb_score"), "start_station_id").limit(n)
    return top.select("start_station_id", "station_name", "imb_score", "direction")


def period_flow(raw: DataFrame) -> DataFrame:
    """Flow per station in the morning and the evening period, from one scan."""
    hour = calendar.start_hour(F.col("start_date"))
    period = F.when(hour.isin(*K.AM_PERIOD_HOURS), K.AM_PERIOD).when(hour.isin(*K.PM_PERIOD_HOURS), K.PM_PERIOD)
    in_period = raw.withColumn("period", period).filter(F.col("period").isNotNull())
    return count_ends(in_period, ["period"])


def period_hotspots(periods: DataFrame, raw_stations: DataFrame, n: int = 15) -> DataFrame:
    """Stations that drain most in the morning and fill most in the evening."""
    names = raw_stations.select(F.col("id").alias("place_id"), F.col("name").alias("station_name"))
    named = periods.join(names, periods.station_id == names.place_id, "inner")
    morning = named.filter(F.col("period") == K.AM_PERIOD)
    evening = named.filter(F.col("period") == K.PM_PERIOD)
    top = (
        morning.orderBy(F.desc("net_flow"), "station_id")
        .limit(n)
        .union(evening.orderBy(F.asc("net_flow"), "station_id").limit(n))
    )
    return top.select(
        "period",
        "station_id",
        "station_name",
        "departures",
        "arrivals",
        "net_flow",
        F.abs("net_flow").alias("bikes"),
    )
