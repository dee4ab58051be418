"""Calendar attributes. Day of week is 1 = Sunday .. 7 = Saturday unless a name says otherwise."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from dockflow import constants as K


def day_of_week(ts: Column) -> Column:
    return F.dayofweek(ts).cast("bigint")


def is_weekend(ts: Column) -> Column:
    return F.dayofweek(ts).isin(1, 7)


def monday_day(ts: Column) -> Column:
    """0 = Monday .. 6 = Sunday, used by the exploratory reports only."""
    return F.weekday(ts).cast("bigint")


def start_hour(ts: Column) -> Column:
    return F.hour(ts).cast("bigint")


def week_number(day: Column) -> Column:
    """Sunday-based week of the year, 0 for the days before the first Sunday."""
    shifted = F.dayofyear(day) + F.lit(7) - F.dayofweek(day)
    return F.floor(shifted / F.lit(7)).cast("bigint")


def _season_index(month: Column) -> Column:
    return F.floor(F.pmod(month, F.lit(12)) / F.lit(3)).cast("int")


def season_code(day: Column) -> Column:
    """0 winter (Dec-Feb), 1 spring, 2 summer, 3 autumn."""
    return _season_index(F.month(day)).cast("bigint")


def season_name(day: Column) -> Column:
    names = F.array(*[F.lit(name) for name in K.SEASONS])
    return F.get(names, _season_index(F.month(day)))


def peak_flag(hour: Column) -> Column:
    return hour.isin(*K.PEAK_HOURS).cast("bigint")


def time_period(hour: Column) -> Column:
    return (
        F.when(hour.between(7, 9), "am_peak")
        .when(hour.between(10, 16), "midday")
        .when(hour.between(17, 19), "pm_peak")
        .when(hour.between(20, 23), "evening")
        .otherwise("night")
    )


def mart_holiday_name(day: Column) -> Column:
    """Name of the bank holiday, NULL on other days."""
    pairs = [F.lit(part) for pair in K.MART_HOLIDAYS for part in pair]
    return F.try_element_at(F.create_map(*pairs), day.cast("string"))


def is_ml_holiday(day: Column) -> Column:
    return day.cast("string").isin(*K.ML_HOLIDAYS).cast("bigint")
