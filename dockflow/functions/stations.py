"""Station attributes: zone, capacity, imbalance, priority, action and marker colours."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from dockflow import constants as K
from dockflow.functions.numeric import ratio


def zone_of(lat: str, lon: str) -> Column:
    """First box that holds the point; unknown coordinates fall outside every box."""
    boxes = " ".join(
        f"WHEN {lat} BETWEEN {lat_lo}D AND {lat_hi}D AND {lon} BETWEEN {lon_lo}D AND {lon_hi}D"
        f" THEN '{name}'"
        for name, lat_lo, lat_hi, lon_lo, lon_hi in K.ZONE_BOXES
    )
    return F.expr(f"CASE {boxes} ELSE '{K.ZONE_ELSE}' END")


def capacity_tier(docks: Column) -> Column:
    small, medium, large = K.CAPACITY_TIERS
    return F.when(docks <= 15, small).when(docks <= 24, medium).otherwise(large)


def imbalance_score(departures: Column, arrivals: Column) -> Column:
    moves = F.greatest(departures + arrivals, F.lit(1))
    return ratio(F.abs(departures - arrivals), moves)


def direction(net_flow: Column, labels=("draining", "filling", "balanced")) -> Column:
    out, into, level = labels
    return F.when(net_flow > 0, out).when(net_flow < 0, into).otherwise(level)


def priority(score: Column, policy: str) -> Column:
    """Tier of a score. Policies share labels but not edges, nor the side that owns an edge."""
    rule = K.PRIORITY_POLICIES[policy]
    medium, high, critical = rule["edges"]
    if rule["closed"] == "left":
        return (
            F.when(score >= critical, "CRITICAL")
            .when(score >= high, "HIGH")
            .when(score >= medium, "MEDIUM")
            .otherwise("LOW")
        )
    low, top = K.SCORE_RANGE
    return (
        F.when(score.isNull() | (score <= low) | (score > top), "nan")
        .when(score <= medium, "LOW")
        .when(score <= high, "MEDIUM")
        .when(score <= critical, "HIGH")
        .otherwise("CRITICAL")
    )


def action(net_flow: Column, dead_band: float) -> Column:
    return (
        F.when(net_flow > dead_band, K.ACTION_DELIVER)
        .when(net_flow < -dead_band, K.ACTION_COLLECT)
        .otherwise(K.ACTION_MONITOR)
    )


def map_colour(score: Column, part: int) -> Column:
    """Marker colour: part 0 is the hex text, parts 1 to 3 are red, green and blue."""
    out = F.lit(K.MAP_COLOUR_ELSE[part])
    for below, *parts in reversed(K.MAP_COLOURS):
        out = F.when(score < below, F.lit(parts[part])).otherwise(out)
    return out


def map_radius(score: Column) -> Column:
    return F.least(score * F.lit(200.0) + F.lit(60.0), F.lit(300.0))


def scenario_colour(score: Column) -> Column:
    out = F.lit(K.SCENARIO_COLOUR_ELSE)
    for at_least, hex_text in reversed(K.SCENARIO_COLOURS):
        out = F.when(score >= at_least, F.lit(hex_text)).otherwise(out)
    return out
