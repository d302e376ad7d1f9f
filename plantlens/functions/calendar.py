"""Columns derived from event times and dates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_key(when: Column) -> Column:
    """Day as an INT such as 20260304, by arithmetic rather than by formatting text."""
    return F.year(when) * 10000 + F.month(when) * 100 + F.dayofmonth(when)


def hour_of_day(when: Column) -> Column:
    return F.hour(when)


def is_weekend(day: Column) -> Column:
    """Saturday or Sunday; `dayofweek` counts from Sunday = 1."""
    return F.coalesce(F.dayofweek(day).isin(1, 7), F.lit(False))


def shift(hour: Column) -> Column:
    """Working shift of an hour; anything outside the two ranges, NULL included, is night."""
    # First and last hour of the day and swing shifts.
    return F.when(hour.between(6, 13), "Day").when(hour.between(14, 21), "Swing").otherwise("Night")


def calendar_columns(day: Column) -> list[Column]:
    """The attributes of the date dimension, in table order."""
    return [
        date_key(day).alias("date_key"),
        day.alias("full_date"),
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.dayofmonth(day).alias("day_of_month"),
        F.dayofweek(day).alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
        F.weekofyear(day).alias("week_of_year"),
        is_weekend(day).alias("is_weekend"),
    ]
