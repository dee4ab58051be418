"""Station reports on the rides counted by day, start station and signal.

``counted`` comes from ``plans.enrich.station_day_rides`` (straight from rides) or
``station_day_rides_of_fact`` (from a stored fact). A row stands for ``n_rides`` fact rows, so a
ride average is an average weighted by ``n_rides``.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockflow import constants as K
from dockflow.functions import stations as S
from dockflow.functions.numeric import percent, ratio, weighted_avg
from dockflow.operators.trends import between_dates, trailing_days

STATION_KEYS = {
    "start_station_name": "station",
    "start_zone": "zone",
    "start_lat": "lat",
    "start_lon": "lon",
    "start_nb_docks": "nb_docks",
}


def _rides() -> Column:
    return F.sum("n_rides")


def _avg_score() -> Column:
    return weighted_avg(F.col("start_station_imbalance_score"), F.col("n_rides"))


def _avg_net_flow() -> Column:
    return weighted_avg(F.col("start_station_net_flow"), F.col("n_rides"))


def _avg_minutes() -> Column:
    return ratio(F.sum("sum_minutes"), _rides())


def _rides_where(condition: Column) -> Column:
    return F.sum(F.when(condition, F.col("n_rides")).otherwise(F.lit(0)))


def _station_keys() -> list[Column]:
    return [F.col(c).alias(out) for c, out in STATION_KEYS.items()]


def kpi_summary(counted: DataFrame, date_from: str, date_to: str) -> DataFrame:
    over = F.col("start_station_imbalance_score") > K.IMBALANCED_ABOVE
    return between_dates(counted, date_from, date_to).agg(
        _rides().alias("total_rides"),
        F.round(_avg_minutes(), 1).alias("avg_duration"),
        F.round(percent(F.sum("n_peak"), _rides()), 1).alias("peak_pct"),
        F.countDistinct("start_station_id").alias("n_stations"),
        F.round(percent(_rides_where(over), _rides()), 1).alias("imbalanced_pct"),
    )


def station_imbalance_recent(counted: DataFrame, as_of: str, days: int = 7) -> DataFrame:
    grouped = (
        trailing_days(counted, as_of, days)
        .groupBy("start_station_id", "start_station_name", "start_lat", "start_lon")
        .agg(_avg_score().alias("avg_imbalance_score"), _rides().alias("ride_count"))
    )
    return grouped.orderBy(F.desc("avg_imbalance_score"), "start_station_id")


def _flow_list(
    counted: DataFrame, date_from: str, date_to: str, min_rides: int, dead_band: float
) -> DataFrame:
    """One row per station and daily direction with more than ``min_rides`` rides."""
    grouped = (
        between_dates(counted, date_from, date_to)
        .groupBy(*_station_keys(), F.col("start_station_imbalance_direction").alias("imb_direction"))
        .agg(
            F.round(_avg_score(), 3).alias("imb_score"),
            F.round(_avg_net_flow(), 1).alias("net_flow"),
            _rides().alias("total_rides"),
        )
        .filter(F.col("total_rides") > min_rides)
    )
    return grouped.select(
        "station",
        "zone",
        "lat",
        "lon",
        "nb_docks",
        "imb_score",
        "net_flow",
        "imb_direction",
        "total_rides",
        S.action(F.col("net_flow"), dead_band).alias("action"),
        S.priority(F.col("imb_score"), "ops").alias("priority"),
    )


def ranked(listing: DataFrame) -> DataFrame:
    return listing.orderBy(F.desc("imb_score"), "station", "imb_direction")


def rebalancing_list(
    counted: DataFrame, date_from: str, date_to: str, min_rides: int = 100
) -> DataFrame:
    return ranked(_flow_list(counted, date_from, date_to, min_rides, dead_band=0.0))


def scenario_list(
    counted: DataFrame, date_from: str, date_to: str, min_rides: int = 50, dead_band: float = 2.0
) -> DataFrame:
    listing = _flow_list(counted, date_from, date_to, min_rides, dead_band)
    return ranked(listing.withColumn("hex_colour", S.scenario_colour(F.col("imb_score"))))


def hotspot_profile(counted: DataFrame, min_rides: int = 500) -> DataFrame:
    draining = F.col("start_station_imbalance_direction") == "draining"
    return (
        counted.groupBy(*_station_keys())
        .agg(
            _rides().alias("total_rides"),
            F.round(_avg_score(), 3).alias("avg_imbalance_score"),
            F.round(_avg_net_flow(), 1).alias("avg_net_flow"),
            ratio(_rides_where(draining), _rides()).alias("pct_days_draining"),
            ratio(_rides_where(F.col("start_station_is_imbalanced")), _rides()).alias(
                "pct_days_imbalanced"
            ),
        )
        .filter(F.col("total_rides") > min_rides)
        .orderBy(F.desc("avg_imbalance_score"), "station")
    )


def draining_filling_top(profile: DataFrame, n: int = 10) -> DataFrame:
    """The stations that lose most and the stations that gain most bikes per day."""
    flow = F.col("avg_net_flow")
    draining = profile.filter(flow > 0).orderBy(flow.desc(), "station").limit(n)
    filling = profile.filter(flow < 0).orderBy(flow.asc(), "station").limit(n)
    columns = ["station", "zone", "avg_net_flow", "avg_imbalance_score"]
    return draining.select(F.lit("draining").alias("side"), *columns).union(
        filling.select(F.lit("filling").alias("side"), *columns)
    )


def station_volume(counted: DataFrame, n: int = 20) -> DataFrame:
    grouped = counted.groupBy("start_station_name", "start_zone").agg(
        _rides().alias("total_departures"),
        F.round(_avg_score(), 3).alias("avg_imbalance_score"),
        F.round(_avg_minutes(), 1).alias("avg_duration_mins"),
        percent(F.sum("n_peak"), _rides()).alias("pct_peak_rides"),
    )
    return grouped.orderBy(F.desc("total_departures"), "start_station_name").limit(n)


def imbalance_trend(counted: DataFrame) -> DataFrame:
    return (
        counted.groupBy("hire_date")
        .agg(
            F.round(_avg_score(), 4).alias("avg_imbalance"),
            ratio(_rides_where(F.col("start_station_is_imbalanced")), _rides()).alias(
                "pct_rides_imbalanced"
            ),
        )
        .orderBy("hire_date")
    )


def _metric_rows(values: DataFrame, metrics: dict[str, tuple[str, str]]) -> DataFrame:
    """Rows (metric, label, value) from one row; ``metrics`` names the label and value columns."""
    rows = ", ".join(
        f"'{metric}', CAST({label} AS STRING), CAST({value} AS DOUBLE)"
        for metric, (label, value) in metrics.items()
    )
    return values.selectExpr(f"stack({len(metrics)}, {rows}) AS (metric, label, value)")


def trend_extremes(counted: DataFrame, rides: DataFrame) -> DataFrame:
    """Mean and worst day of the imbalance trend, best and worst month, busiest hours.

    Ties go to the earlier day, month or hour. Months and hours come from one count of the rides.
    """
    trend = imbalance_trend(counted).selectExpr(
        "avg_imbalance", "struct(avg_imbalance, -unix_date(hire_date) AS d, hire_date) AS ranked"
    )
    days = trend.agg(F.avg("avg_imbalance").alias("mean"), F.max("ranked").alias("top")).selectExpr(
        "mean", "top.hire_date AS worst_day", "top.avg_imbalance AS worst"
    )
    cells = rides.groupBy(
        F.trunc("hire_date", "MONTH").alias("month"), "start_hour", "is_weekend"
    ).agg(F.count(F.lit(1)).alias("n"))
    months = (
        cells.groupBy("month")
        .agg(F.sum("n").alias("n"))
        .selectExpr(
            "struct(n, -unix_date(month) AS d, month) AS best",
            "struct(-n AS n, -unix_date(month) AS d, month) AS least",
        )
        .agg(F.max("best").alias("best"), F.max("least").alias("least"))
    )
    hours = (
        cells.groupBy("start_hour", "is_weekend")
        .agg(F.sum("n").alias("n"))
        .selectExpr("is_weekend", "struct(n, -start_hour AS h, start_hour) AS r")
        .agg(
            F.max(F.when(~F.col("is_weekend"), F.col("r"))).alias("weekday"),
            F.max(F.when(F.col("is_weekend"), F.col("r"))).alias("weekend"),
        )
    )
    return (
        _metric_rows(
            days, {"mean_imbalance": ("NULL", "mean"), "max_imbalance_day": ("worst_day", "worst")}
        )
        .union(
            _metric_rows(
                months,
                {
                    "peak_month": ("best.month", "best.n"),
                    "trough_month": ("least.month", "-least.n"),
                },
            )
        )
        .union(
            _metric_rows(
                hours,
                {
                    "weekday_peak_hour": ("weekday.start_hour", "weekday.n"),
                    "weekend_peak_hour": ("weekend.start_hour", "weekend.n"),
                },
            )
        )
    )
