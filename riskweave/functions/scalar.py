"""Scalar column functions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS_PER_DAY = 86_400_000_000


def day_of_week(ts: Column) -> Column:
    """Monday = 0 … Sunday = 6."""
    return F.weekday(ts)


def is_weekend(day: Column) -> Column:
    """1 on days 5 and 6, else 0; a null day counts as 0."""
    return F.coalesce(day.isin(5, 6), F.lit(False)).cast("int")


def is_night(hour: Column) -> Column:
    """1 for hours 0 to 5, else 0; a null hour counts as 0."""
    return F.coalesce(hour.between(0, 5), F.lit(False)).cast("int")


def micros(ts: Column) -> Column:
    """Microseconds since 1970 of a zone-less timestamp, whatever the session time zone."""
    seconds = F.hour(ts) * F.lit(3600) + F.minute(ts) * F.lit(60)
    fraction = (F.date_part(F.lit("SECOND"), ts) * F.lit(1_000_000)).cast("long")
    day = F.unix_date(ts.cast("date")).cast("long")
    return day * F.lit(MICROS_PER_DAY) + seconds.cast("long") * F.lit(1_000_000) + fraction


def ratio(top: Column, bottom: Column) -> Column:
    """Double division; null when the divisor is zero, also in ANSI mode."""
    return F.try_divide(top.cast("double"), bottom.cast("double"))


def ratio_or_zero(top: Column, bottom: Column) -> Column:
    return F.coalesce(ratio(top, bottom), F.lit(0.0))


def percent(part: Column, whole: Column, digits: int) -> Column:
    """``100 * part / whole`` in doubles, rounded half away from zero."""
    return F.round(ratio(part.cast("double") * F.lit(100.0), whole), digits)


def round_half_even(value: Column, digits: int = 0) -> Column:
    return F.bround(value, digits)
