"""Calendar fields of a pickup time."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed values.
SEASON_OF_MONTHS = {"Winter": (12, 1, 2), "Spring": (3, 4, 5), "Summer": (6, 7, 8)}
LAST_SEASON = "Fall"
WEEKDAY_NAMES = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday")
MORNING_RUSH = (7, 9)
EVENING_RUSH = (16, 19)


def hour_start(timestamp: Column) -> Column:
    """The clock hour; ``date_trunc`` alone would change the type to a zoned one."""
    return F.date_trunc("hour", timestamp).cast("timestamp_ntz")


def seconds_between(start: Column, end: Column) -> Column:
    return F.unix_timestamp(end) - F.unix_timestamp(start)


def minutes_between(start: Column, end: Column) -> Column:
    return seconds_between(start, end) / F.lit(60.0)


def season(month: Column) -> Column:
    label = F.lit(LAST_SEASON)
    for name, months in SEASON_OF_MONTHS.items():
        label = F.when(month.isin(*months), name).otherwise(label)
    return label


def iso_weekday(date: Column) -> Column:
    """1 for Monday to 7 for Sunday."""
    return F.weekday(date) + F.lit(1)


def in_rush_hours(hour: Column) -> Column:
    return hour.between(*MORNING_RUSH) | hour.between(*EVENING_RUSH)


def is_rush_hour(date: Column, hour: Column) -> Column:
    return iso_weekday(date).between(1, 5) & in_rush_hours(hour)


def calendar_fields(timestamp: Column) -> dict[str, Column]:
    """All derived calendar columns of a pickup time, by output name."""
    month = F.month(timestamp)
    return {
        "pickup_hour": hour_start(timestamp),
        "pickup_date": F.to_date(timestamp),
        "pickup_year": F.year(timestamp),
        "pickup_month": month,
        "pickup_day": F.dayofmonth(timestamp),
        "pickup_day_of_week": F.date_format(timestamp, "EEEE"),
        "season": season(month),
        "pickup_hour_of_day": F.hour(timestamp),
    }
