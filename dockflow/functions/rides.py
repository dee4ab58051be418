"""Ride attributes: duration, bands, round trips and keys."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from dockflow import constants as K


def duration_minutes(seconds: Column) -> Column:
    return F.round(seconds / F.lit(60.0), 1)


def duration_band(seconds: Column) -> Column:
    short, medium, long, extended = K.DURATION_BANDS
    return (
        F.when(seconds < 600, short)
        .when(seconds < 1800, medium)
        .when(seconds < 3600, long)
        .otherwise(extended)
    )


def eda_band(minutes: Column) -> Column:
    """Right-closed band of the exploratory reports, NULL outside (0, 1440]."""
    return F.coalesce(
        *[F.when((minutes > low) & (minutes <= high), F.lit(label)) for label, low, high in K.EDA_BANDS]
    )


def is_round_trip(start_id: Column, end_id: Column) -> Column:
    return F.coalesce(start_id == end_id, F.lit(False))


def surrogate_key(*columns: Column) -> Column:
    """md5 over the text of the columns joined by '-', with a fixed text for NULL."""
    parts = [F.coalesce(c.cast("string"), F.lit(K.NULL_KEY_TEXT)) for c in columns]
    return F.md5(F.concat_ws("-", *parts))
