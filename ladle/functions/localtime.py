"""Zone-local time and the calendar values derived from it."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values: (month, day) of the holidays.
HOLIDAYS = [(1, 1), (7, 4), (11, 11), (12, 25), (12, 31)]

# Relative order volume by local hour, midnight first.
HOUR_WEIGHTS = [
    0.2, 0.1, 0.1, 0.1, 0.1, 0.2, 0.4, 0.6,
    0.8, 0.6, 0.5, 0.9, 1.6, 1.4, 0.8, 0.6,
    0.7, 1.0, 1.7, 2.0, 1.6, 1.1, 0.8, 0.5,
]
WEEKEND_WEIGHT = 1.35
HOLIDAY_WEIGHT = 1.5


def local_time(utc: Column, timezone: Column) -> Column:
    """A UTC instant (without zone) as the wall-clock time of a zone."""
    return F.convert_timezone(F.lit("UTC"), timezone, utc)


def is_weekend(moment: Column) -> Column:
    """Saturday or Sunday; ``weekday`` counts from Monday = 0."""
    return F.weekday(moment) >= 5


def daypart(hour: Column) -> Column:
    return (
        F.when(hour.between(6, 10), "breakfast")
        .when(hour.between(11, 14), "lunch")
        .when(hour.between(15, 20), "dinner")
        .otherwise("late_night")
    )


def is_holiday(day: Column) -> Column:
    return (F.month(day) * 100 + F.dayofmonth(day)).isin([m * 100 + d for m, d in HOLIDAYS])


def _on_day(weight: Column, day: Column) -> Column:
    return (
        weight
        * F.when(is_weekend(day), WEEKEND_WEIGHT).otherwise(1.0)
        * F.when(is_holiday(day), HOLIDAY_WEIGHT).otherwise(1.0)
    )


def hour_weight(day: Column, hour: Column) -> Column:
    return _on_day(F.element_at(F.array(*[F.lit(w) for w in HOUR_WEIGHTS]), hour + 1), day)


def day_weight(day: Column) -> Column:
    """The hour weights of a whole day; the day's factors apply to every hour."""
    return _on_day(F.lit(sum(HOUR_WEIGHTS)), day)


def date_key(day: Column, hour: Column) -> Column:
    """YYYYMMDDHH as a number."""
    ymd = F.year(day).cast("long") * 10000 + F.month(day) * 100 + F.dayofmonth(day)
    return ymd * 100 + hour
