"""Arithmetic shared by the reports."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(num: Column, den: Column) -> Column:
    """``num / den`` as double, NULL where the denominator is zero."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def percent(num: Column, den: Column) -> Column:
    return ratio(num, den) * F.lit(100.0)


def count_where(condition: Column) -> Column:
    """Rows where the condition holds, as bigint. NULL counts as false."""
    return F.count_if(condition)


def weighted_avg(value: Column, weight: Column) -> Column:
    """Average of ``value`` where each row stands for ``weight`` rows, skipping NULL values."""
    return ratio(F.sum(value * weight), F.sum(F.when(value.isNotNull(), weight)))


def half_even(value: Column, digits: int = 0) -> Column:
    """Round ties to the even neighbour after scaling, as the planning numbers require."""
    scale = F.lit(10.0**digits)
    return F.rint(value * scale) / scale
