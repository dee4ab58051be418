"""Crew planning on the rebalancing and scenario lists: one row per station and direction."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockflow import constants as K
from dockflow.functions import stations as S
from dockflow.functions.numeric import half_even

BOTH_ACTIONS = [K.ACTION_DELIVER, K.ACTION_COLLECT]
URGENT = ["CRITICAL", "HIGH"]
DEFAULT_CENTRE = (51.508, -0.128)


def _n() -> Column:
    return F.count(F.lit(1))


def pick(listing: DataFrame, actions: list[str], priorities: list[str]) -> DataFrame:
    return listing.filter(F.col("action").isin(*actions) & F.col("priority").isin(*priorities))


def dispatch_list(
    listing: DataFrame, actions: list[str] = BOTH_ACTIONS, priorities: list[str] = URGENT
) -> DataFrame:
    """The ranked work list that crews receive."""
    return (
        pick(listing, actions, priorities)
        .select(
            "station",
            "priority",
            "action",
            "imb_score",
            "net_flow",
            "nb_docks",
            F.col("net_flow").cast("bigint").alias("bikes_per_day"),
            F.coalesce("nb_docks", F.lit(0)).alias("docks"),
        )
        .orderBy(F.desc("imb_score"), "station")
    )


def danger_zone(listing: DataFrame, fallback: int = 20) -> DataFrame:
    """Urgent stations with coordinates; without any, the first ``fallback`` stations by score.

    ``is_fallback`` tells which of the two the rows are.
    """
    urgent = listing.filter(F.col("priority").isin(*URGENT))
    n_urgent = urgent.agg(_n()).scalar()
    ranked = listing.orderBy(F.desc("imb_score"), "station", "imb_direction").limit(fallback)
    calm = ranked.filter(n_urgent == 0).withColumn("is_fallback", F.lit(True))
    rows = urgent.withColumn("is_fallback", F.lit(False)).union(calm)
    return rows.filter(F.col("lat").isNotNull() & F.col("lon").isNotNull())


def map_centre(places: DataFrame, lat: str = "lat", lon: str = "lon") -> DataFrame:
    return places.agg(
        F.coalesce(F.avg(lat), F.lit(DEFAULT_CENTRE[0])).alias("centre_lat"),
        F.coalesce(F.avg(lon), F.lit(DEFAULT_CENTRE[1])).alias("centre_lon"),
    )


def station_at_point(listing: DataFrame, lat: float, lon: float) -> DataFrame:
    """Stations whose coordinates agree with the point to four decimals."""
    at_lat = half_even(F.col("lat"), 4) == F.lit(round(lat, 4))
    at_lon = half_even(F.col("lon"), 4) == F.lit(round(lon, 4))
    return listing.filter(at_lat & at_lon)


def _runs(stations: Column) -> Column:
    """Crew runs for a number of stations, at least one."""
    runs = half_even(stations / F.lit(float(K.STATIONS_PER_RUN)))
    return F.greatest(runs, F.lit(1.0)).cast("bigint")


def crew_plan(
    rebalancing: DataFrame,
    scenario: DataFrame,
    actions: list[str] = BOTH_ACTIONS,
    priorities: list[str] = URGENT,
) -> DataFrame:
    """Counts and crew runs of both lists.

    The rebalancing list counts runs for its urgent stations, the scenario list for all picked.
    """
    def counted(listing: DataFrame, name: str, for_run: Column) -> DataFrame:
        picked = F.col("action").isin(*actions) & F.col("priority").isin(*priorities)
        return listing.agg(
            F.lit(name).alias("plan"),
            F.count_if(F.col("priority") == "CRITICAL").alias("n_critical"),
            F.count_if(F.col("priority") == "HIGH").alias("n_high"),
            F.count_if(picked).alias("n_action"),
            F.count_if(picked & (F.col("action") == K.ACTION_DELIVER)).alias("n_deliver"),
            F.count_if(picked & (F.col("action") == K.ACTION_COLLECT)).alias("n_collect"),
            _runs(F.count_if(picked & for_run)).alias("crew_runs"),
        )

    urgent_only = counted(rebalancing, "rebalancing", F.col("priority").isin(*URGENT))
    return urgent_only.union(counted(scenario, "scenario", F.lit(True)))


def action_statement(
    listing: DataFrame, actions: list[str] = BOTH_ACTIONS, priorities: list[str] = URGENT
) -> DataFrame:
    """How many stations to clear, how urgently and within how many hours."""
    worst = F.max("imb_score")
    urgency, hours = F.lit(K.URGENCY_ELSE[0]), F.lit(K.URGENCY_ELSE[1])
    for at_least, label, within in reversed(K.URGENCY_TIERS):
        urgency = F.when(worst >= at_least, label).otherwise(urgency)
        hours = F.when(worst >= at_least, within).otherwise(hours)
    some = _n() > 0
    return pick(listing, actions, priorities).agg(
        _n().alias("stations"),
        F.count_if(F.col("action") == K.ACTION_DELIVER).alias("deliveries"),
        F.count_if(F.col("action") == K.ACTION_COLLECT).alias("collections"),
        _runs(_n()).alias("crew_runs"),
        worst.alias("worst_score"),
        F.when(some, urgency).otherwise("all clear").alias("urgency"),
        F.when(some, hours).cast("bigint").alias("within_hours"),
    )


def dispatch_recommendation(listing: DataFrame, now_hour: int) -> DataFrame:
    """When to leave for every station that needs a crew, and with how many bikes."""
    next_peak = F.lit(min(K.PEAK_HOURS)).cast("bigint")
    wait = F.pmod(next_peak - F.lit(now_hour), F.lit(24)).cast("bigint")
    bikes = F.greatest(half_even(F.abs("net_flow")), F.lit(1.0)).cast("bigint")
    return listing.filter(F.col("action") != K.ACTION_MONITOR).select(
        "station",
        "imb_direction",
        "action",
        next_peak.alias("next_peak_hour"),
        F.format_string("%02d:00", next_peak).alias("next_peak_label"),
        wait.alias("hours_to_peak"),
        F.greatest(wait - 1, F.lit(1)).cast("bigint").alias("dispatch_window"),
        bikes.alias("bikes_needed"),
    )


def station_map(dim_stations: DataFrame) -> DataFrame:
    """Marker attributes of every station of the dimension."""
    score, net = F.col("imb_score"), F.col("net_flow")
    base = dim_stations.select(
        F.col("station_id").alias("id"),
        F.col("station_name").alias("name"),
        "zone",
        "latitude",
        "longitude",
        F.col("nb_docks").alias("nbdocks"),
        F.col("rebalancing_priority").alias("priority"),
        F.col("avg_imbalance_score_7d").alias("imb_score"),
        F.col("total_departures_all_time").alias("departures"),
        F.col("total_arrivals_all_time").alias("arrivals"),
        (F.col("total_departures_all_time") - F.col("total_arrivals_all_time")).alias("net_flow"),
    )
    direction = S.direction(net)
    return base.withColumns(
        {
            "imb_direction": direction,
            "direction_label": F.initcap(direction),
            "net_flow_label": F.format_string("%+d", net),
            "hex_colour": S.map_colour(score, 0),
            "red": S.map_colour(score, 1).cast("bigint"),
            "green": S.map_colour(score, 2).cast("bigint"),
            "blue": S.map_colour(score, 3).cast("bigint"),
            "radius": S.map_radius(score),
        }
    )


def filter_map(markers: DataFrame, priorities: list[str], directions: list[str]) -> DataFrame:
    return markers.filter(
        F.col("priority").isin(*priorities) & F.col("imb_direction").isin(*directions)
    )


def map_summary(markers: DataFrame) -> DataFrame:
    return markers.agg(
        _n().alias("stations"),
        F.count_if(F.col("priority") == "CRITICAL").alias("critical"),
        F.count_if(F.col("imb_direction") == "draining").alias("draining"),
    )
