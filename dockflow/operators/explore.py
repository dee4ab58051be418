"""Exploratory reports on raw rides. Weekend means Saturday and Sunday, minutes are not rounded."""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockflow import constants as K
from dockflow.functions import calendar, rides as R
from dockflow.functions.numeric import percent, ratio
from dockflow.sources.literals import literal_rows


def explored(raw: DataFrame) -> DataFrame:
    """Raw rides with the attributes the exploratory reports use."""
    start = F.col("start_date")
    minutes = F.col("duration") / F.lit(60.0)
    hour = calendar.start_hour(start)
    return raw.withColumns(
        {
            "hire_date": F.to_date(start),
            "start_hour": hour,
            "day_of_week": calendar.monday_day(start),
            "day_name": F.date_format(start, "EEEE"),
            "month": F.month(start).cast("bigint"),
            "month_name": F.date_format(start, "MMM yyyy"),
            "is_weekend": calendar.monday_day(start) >= 5,
            "duration_minutes": minutes,
            "peak_hour_flag": calendar.peak_flag(hour),
            "duration_band": R.eda_band(minutes),
        }
    )


def _n() -> Column:
    return F.count(F.lit(1))


def _by_duration(rides: DataFrame) -> DataFrame:
    """Rides per distinct duration, weekend and peak flag: small enough for exact quantiles."""
    return rides.groupBy("duration_minutes", "is_weekend", "peak_hour_flag").agg(_n().alias("n"))


def ride_summary(rides: DataFrame) -> DataFrame:
    """One row of headline numbers, the median exact."""
    distinct = rides.agg(
        F.countDistinct("start_station_id").alias("unique_stations"),
        F.countDistinct("bike_id").alias("unique_bikes"),
    )
    minutes, n = F.col("duration_minutes"), F.col("n")
    total = F.sum(n)
    known = F.sum(F.when(minutes.isNotNull(), n))
    return _by_duration(rides).agg(
        total.alias("total_rides"),
        distinct.select("unique_stations").scalar().alias("unique_stations"),
        distinct.select("unique_bikes").scalar().alias("unique_bikes"),
        ratio(F.sum(minutes * n), known).alias("avg_minutes"),
        F.percentile(minutes, F.lit(0.5), n).alias("median_minutes"),
        F.min(minutes).alias("min_minutes"),
        F.max(minutes).alias("max_minutes"),
        (F.sum(minutes * n) / F.lit(60.0)).alias("total_hours"),
        percent(F.sum(F.col("peak_hour_flag") * n), total).alias("peak_pct"),
        percent(F.sum(F.when(F.col("is_weekend"), n).otherwise(0)), total).alias("weekend_pct"),
    )


def duration_bands(rides: DataFrame) -> DataFrame:
    """Rides and share per band; rides outside all bands count in the total only."""
    counted = rides.groupBy("duration_band").agg(_n().alias("rides"))
    total = counted.agg(F.sum("rides")).scalar()
    return counted.filter(F.col("duration_band").isNotNull()).select(
        "duration_band", "rides", percent(F.col("rides"), total).alias("pct")
    )


def hourly_profile(rides: DataFrame, group: str) -> DataFrame:
    """Share of each start hour within its group, in percent."""
    counted = rides.groupBy(group, "start_hour").agg(_n().alias("rides"))
    totals = counted.groupBy(F.col(group).alias("total_of")).agg(F.sum("rides").alias("total"))
    joined = counted.join(totals, F.col(group).eqNullSafe(F.col("total_of")))
    return joined.select(
        group, "start_hour", "rides", percent(F.col("rides"), F.col("total")).alias("pct")
    ).orderBy(group, "start_hour")


def dow_counts(rides: DataFrame) -> DataFrame:
    """Rides per day name in calendar order; a day without rides shows zero."""
    days = literal_rows(rides.sparkSession, ["day_order", "day_name"], list(enumerate(K.DAY_NAMES)))
    counted = rides.groupBy("day_name").agg(_n().alias("rides"))
    return (
        days.join(counted, "day_name", "left")
        .select(
            F.col("day_order").cast("bigint").alias("day_order"),
            "day_name",
            F.coalesce("rides", F.lit(0)).alias("rides"),
        )
        .orderBy("day_order")
    )


def month_counts(rides: DataFrame) -> DataFrame:
    names = F.array(*[F.lit(name) for name in K.MONTH_ABBR])
    label = F.get(names, (F.col("month") - 1).cast("int"))
    return (
        rides.groupBy("month")
        .agg(_n().alias("rides"))
        .select("month", label.alias("month_label"), "rides")
        .orderBy("month")
    )


def dow_hour_pivot(rides: DataFrame) -> DataFrame:
    """Day by hour matrix with columns h00 to h23; absent hours are zero."""
    hours = [F.count_if(F.col("start_hour") == h).alias(f"h{h:02d}") for h in range(24)]
    return rides.groupBy("day_of_week").agg(*hours).orderBy("day_of_week")


def peak_offpeak(rides: DataFrame) -> DataFrame:
    peak, weekend = F.col("peak_hour_flag") == 1, F.col("is_weekend")
    n = F.col("n")
    daily = rides.groupBy("hire_date", "is_weekend", "peak_hour_flag").agg(
        _n().alias("n"), F.sum("duration_minutes").alias("minutes")
    )
    n_peak = F.sum(F.when(peak, n).otherwise(0))
    n_off = F.sum(F.when(~peak, n).otherwise(0))
    n_weekend = F.sum(F.when(weekend, n).otherwise(0))
    n_week = F.sum(F.when(~weekend, n).otherwise(0))
    days = lambda which: F.countDistinct(F.when(which, F.col("hire_date")))
    minutes = lambda which: F.sum(F.when(which, F.col("minutes")))
    return daily.agg(
        n_peak.alias("peak_rides"),
        n_off.alias("offpeak_rides"),
        percent(n_peak, F.sum(n)).alias("peak_pct"),
        percent(n_off, F.sum(n)).alias("offpeak_pct"),
        ratio(n_peak, n_off).alias("peak_ratio"),
        ratio(n_week, days(~weekend)).alias("weekday_rides_per_day"),
        ratio(n_weekend, days(weekend)).alias("weekend_rides_per_day"),
        (ratio(minutes(weekend), n_weekend) - ratio(minutes(~weekend), n_week)).alias(
            "weekend_extra_minutes"
        ),
    )


def histogram(
    values: DataFrame, series: str, value: str, bins: dict[str, int], weight: str | None = None
) -> DataFrame:
    """Equal-width histogram per series between its minimum and maximum, the last bin closed.

    ``bins`` gives the number of bins of every series, and a series that it lacks is an error; a row counts
    once, or ``weight`` times. Values are counted before they are binned. Empty bins are kept.
    """
    spark = values.sparkSession
    size = _n() if weight is None else F.sum(weight)
    known = F.when(F.col(series).isin(*bins), F.col(series)).otherwise(
        F.raise_error(F.concat(F.lit("no number of bins for series "), F.coalesce(F.col(series), F.lit("NULL"))))
    )
    checked = values.filter(F.col(value).isNotNull()).withColumn(series, known)
    counted = checked.groupBy(series, value).agg(size.alias("n"))
    ranges = counted.groupBy(series).agg(
        F.min(value).alias("low"), F.max(value).alias("high"), F.sum("n").alias("total")
    )
    # A handful of series: their ranges travel as one small map instead of a join.
    entry = F.struct(F.col(series), F.struct("low", "high", "total"))
    range_of = ranges.agg(F.map_from_entries(F.collect_list(entry)).alias("m")).scalar()
    bin_counts = F.create_map(*[F.lit(part) for pair in bins.items() for part in pair])

    def with_range(frame: DataFrame) -> DataFrame:
        found = frame.withColumns(
            {"r": F.element_at(range_of, F.col(series)), "bins": F.element_at(bin_counts, F.col(series))}
        ).filter(F.col("r").isNotNull())
        return found.withColumn("width", (F.col("r.high") - F.col("r.low")) / F.col("bins"))

    position = F.floor(F.try_divide(F.col(value) - F.col("r.low"), F.col("width")))
    bin_of = F.least(F.coalesce(position, F.lit(0)), F.col("bins") - F.lit(1)).cast("bigint")
    filled = with_range(counted).groupBy(series, bin_of.alias("bin")).agg(F.sum("n").alias("n"))
    series_bins = literal_rows(spark, [series, "last"], [(k, count - 1) for k, count in bins.items()])
    first, last = F.lit(0).cast("bigint"), F.col("last").cast("bigint")
    slots = series_bins.select(series, F.explode(F.sequence(first, last)).alias("bin"))
    n = F.coalesce(F.col("n"), F.lit(0))
    return with_range(slots.join(filled, [series, "bin"], "left")).select(
        series,
        "bin",
        (F.col("r.low") + F.col("bin") * F.col("width")).alias("bin_low"),
        n.alias("n"),
        ratio(n, F.col("r.total") * F.col("width")).alias("density"),
    )


def duration_histogram(rides: DataFrame, clip_at: float = 90.0) -> DataFrame:
    """All rides in 80 bins; weekday and weekend rides clipped at 90 minutes in 40 bins."""
    minutes = F.col("duration_minutes")
    kind = F.when(F.col("is_weekend"), "weekend").otherwise("weekday")
    values = rides.select(
        minutes.alias("m"), F.least(minutes, F.lit(clip_at)).alias("clipped"), kind.alias("kind")
    ).selectExpr("stack(2, 'all', m, kind, clipped) AS (series, minutes)")
    return histogram(values, "series", "minutes", {"all": 80, "weekday": 40, "weekend": 40})


def flow_histogram(flow: DataFrame) -> DataFrame:
    """Net flow of the stations in 50 bins."""
    values = flow.select(
        F.lit("net_flow").alias("series"), F.col("net_flow").cast("double").alias("net_flow")
    )
    return histogram(values, "series", "net_flow", {"net_flow": 50})


def mart_durations(rides: DataFrame) -> DataFrame:
    """Mart rides in 60 bins, with the median and the mean of all of them in each row."""
    values = rides.select(F.lit("rides").alias("series"), "duration_minutes")
    bins = histogram(values, "series", "duration_minutes", {"rides": 60})
    return bins.select(
        "bin",
        "bin_low",
        "n",
        rides.agg(F.median("duration_minutes")).scalar().alias("median"),
        rides.agg(F.avg("duration_minutes")).scalar().alias("mean"),
    )


def key_findings(rides: DataFrame, flow: DataFrame, labelled: DataFrame | None = None) -> DataFrame:
    """The numbers behind the findings, one per row; the commuter share only with labelled points."""
    short_label = K.EDA_BANDS[0][0]
    ride_part = rides.agg(
        percent(F.count_if(F.col("duration_band") == short_label), _n()).alias("pct_short"),
        percent(F.sum("peak_hour_flag"), _n()).alias("pct_peak"),
        (
            F.avg(F.when(F.col("is_weekend"), F.col("duration_minutes")))
            - F.avg(F.when(~F.col("is_weekend"), F.col("duration_minutes")))
        ).alias("weekend_extra_minutes"),
    )
    over = F.col("imb_score") > K.IMBALANCED_ABOVE
    flow_part = flow.agg(
        percent(F.count_if(over), _n()).alias("pct_imbalanced"),
        F.avg("imb_score").alias("avg_imb_score"),
        F.count_if(F.col("priority") == "CRITICAL").cast("double").alias("n_critical"),
    )
    parts = [p.unpivot([], p.columns, "metric", "value") for p in (ride_part, flow_part)]
    if labelled is not None:
        from dockflow.operators.segments import commuter_share  # segments builds on this module

        parts.append(commuter_share(labelled))
    return reduce(DataFrame.union, parts)


def column_profile(table: DataFrame) -> DataFrame:
    """Type, NULL count and distinct count of every column.

    Each column is counted by itself in its own type: a scan of that column alone, counts combined before a shuffle of
    its distinct values. Spark groups 0.0 with -0.0, and instants by time, not by their local text.
    """

    def one(field):
        counted = table.select(F.col(field.name).alias("v")).groupBy("v").agg(_n().alias("n"))
        return counted.agg(
            F.lit(field.name).alias("column_name"),
            F.lit(field.dataType.simpleString()).alias("dtype"),
            F.coalesce(F.sum(F.when(F.col("v").isNull(), F.col("n"))), F.lit(0)).alias("nulls"),
            F.count("v").alias("unique_values"),
        )

    return reduce(DataFrame.union, map(one, table.schema))
