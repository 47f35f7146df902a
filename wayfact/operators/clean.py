"""From raw trip records to clean trips with calendar and tip columns."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from wayfact.functions import calendar, conditions
from wayfact.functions.exact import percent

# Raw column, canonical column, type.
TRIP_COLUMNS = (
    ("tpep_pickup_datetime", "pickup_timestamp", "timestamp_ntz"),
    ("tpep_dropoff_datetime", "dropoff_timestamp", "timestamp_ntz"),
    ("PULocationID", "pickup_location_id", "int"),
    ("passenger_count", "passenger_count", "double"),
    ("trip_distance", "trip_distance_miles", "double"),
    ("payment_type", "payment_type", "int"),
    ("fare_amount", "fare_amount", "double"),
    ("tip_amount", "tip_amount", "double"),
    ("total_amount", "total_amount", "double"),
)
TIMESTAMP_COLUMNS = ("tpep_pickup_datetime", "tpep_dropoff_datetime")
NUMERIC_COLUMNS = tuple(raw for raw, _, _ in TRIP_COLUMNS if raw not in TIMESTAMP_COLUMNS)

Bounds = tuple[float | None, float | None]


@dataclass(frozen=True)
class HourlyLimits:
    """Inclusive bounds of a plausible trip in the hourly pipeline."""

    location: Bounds = (1, 265)
    minutes: Bounds = (1.0, 180.0)
    distance: Bounds = (0.1, 100.0)
    fare: Bounds = (0.0, 1000.0)
    tip: Bounds = (0.0, 1000.0)
    total: Bounds = (0.0, 2000.0)


@dataclass(frozen=True)
class DailyLimits:
    """Upper bounds (inclusive) of the daily pipeline; distance and total are above zero."""

    distance: float = 100.0
    fare: float = 500.0
    total: float = 1000.0
    minutes: tuple[float, float] = (1.0, 240.0)


def inside(value: Column, bounds: Bounds) -> Column:
    """Not null and within the inclusive bounds; an absent bound is open."""
    low, high = bounds
    test = value.isNotNull()
    if low is not None:
        test = test & (value >= low)
    if high is not None:
        test = test & (value <= high)
    return test


def canonical_trips(raw: DataFrame, types: Mapping[str, str] | None = None) -> DataFrame:
    """Rename and cast the raw trip columns; ``types`` overrides canonical types."""
    types = types or {}
    return raw.select(
        *[F.col(name).cast(types.get(out, kind)).alias(out) for name, out, kind in TRIP_COLUMNS]
    )


def in_period(timestamp: Column, start: str, end: str) -> Column:
    """Half-open period. The literals take the column's type, so scans can use them."""
    return (timestamp >= F.lit(start).cast("timestamp_ntz")) & (
        timestamp < F.lit(end).cast("timestamp_ntz")
    )


def with_duration(trips: DataFrame) -> DataFrame:
    return trips.withColumn(
        "trip_duration_minutes",
        calendar.minutes_between(F.col("pickup_timestamp"), F.col("dropoff_timestamp")),
    )


def with_calendar(trips: DataFrame) -> DataFrame:
    return trips.withColumns(calendar.calendar_fields(F.col("pickup_timestamp")))


def with_card_tip(trips: DataFrame) -> DataFrame:
    return trips.withColumn(
        "card_tip_percentage",
        conditions.card_tip_percentage(
            F.col("payment_type"), F.col("tip_amount"), F.col("fare_amount")
        ),
    )


def plausible_hourly(limits: HourlyLimits = HourlyLimits()) -> Column:
    return (
        F.col("pickup_timestamp").isNotNull()
        & F.col("dropoff_timestamp").isNotNull()
        & inside(F.col("pickup_location_id"), limits.location)
        & inside(F.col("trip_duration_minutes"), limits.minutes)
        & inside(F.col("trip_distance_miles"), limits.distance)
        & inside(F.col("fare_amount"), limits.fare)
        & inside(F.col("tip_amount"), limits.tip)
        & inside(F.col("total_amount"), limits.total)
    )


def clean_hourly(
    trips: DataFrame, start: str, end: str, limits: HourlyLimits = HourlyLimits()
) -> DataFrame:
    """Canonical trips of a period that pass the hourly bounds, with duration."""
    period = trips.where(in_period(F.col("pickup_timestamp"), start, end))
    return with_duration(period).where(plausible_hourly(limits))


def prepared_hourly(
    trips: DataFrame, start: str, end: str, limits: HourlyLimits = HourlyLimits()
) -> DataFrame:
    """Clean trips with every derived column the joins and summaries need."""
    return with_card_tip(with_calendar(clean_hourly(trips, start, end, limits)))


def plausible_daily(limits: DailyLimits = DailyLimits()) -> Column:
    minutes = F.col("trip_duration_minutes")
    return (
        (F.col("trip_distance_miles") > 0)
        & (F.col("trip_distance_miles") <= limits.distance)
        & (F.col("fare_amount") >= 0)
        & (F.col("fare_amount") <= limits.fare)
        & (F.col("total_amount") > 0)
        & (F.col("total_amount") <= limits.total)
        & (minutes >= limits.minutes[0])
        & (minutes <= limits.minutes[1])
    )


def with_daily_columns(trips: DataFrame) -> DataFrame:
    """Pickup date, duration from the whole-second difference, unbounded card tip rate."""
    seconds = F.timestamp_diff("SECOND", F.col("pickup_timestamp"), F.col("dropoff_timestamp"))
    return trips.withColumns(
        {
            "pickup_date": F.to_date("pickup_timestamp"),
            "trip_duration_minutes": seconds.cast("double") / F.lit(60.0),
            "tip_percentage": F.when(
                (F.col("payment_type") == conditions.CARD) & (F.col("fare_amount") > 0),
                F.lit(100.0) * F.col("tip_amount") / F.col("fare_amount"),
            ),
        }
    )


def within_dates(date: Column, first: str, last: str) -> Column:
    return (date >= F.lit(first).cast("date")) & (date <= F.lit(last).cast("date"))


def clean_daily(
    trips: DataFrame, first: str, last: str, limits: DailyLimits = DailyLimits()
) -> DataFrame:
    """Canonical trips between two dates (both included) that pass the daily bounds.

    The dates are compared as a period of the timestamp, which a scan can use.
    """
    after_last = (dt.date.fromisoformat(last) + dt.timedelta(days=1)).isoformat()
    period = trips.where(in_period(F.col("pickup_timestamp"), first, after_last))
    return with_daily_columns(period).where(plausible_daily(limits))


def quality_report(raw: DataFrame, kept: Column) -> DataFrame:
    """Rows before and after a filter, removed rows and rate, in one pass."""
    counts = raw.agg(
        F.count(F.lit(1)).alias("raw_rows"), F.count_if(kept).alias("clean_rows")
    )
    removed = F.col("raw_rows") - F.col("clean_rows")
    return counts.select(
        "raw_rows",
        "clean_rows",
        removed.alias("removed_rows"),
        F.coalesce(percent("raw_rows - clean_rows", "raw_rows"), F.lit(0.0)).alias("removed_rate_pct"),
    )


def refund_share(trips: DataFrame, amount: str) -> DataFrame:
    """Rows with a negative amount, and their share of all rows."""
    counts = trips.agg(
        F.count_if(F.col(amount) < 0).alias("negative_rows"),
        F.count(F.lit(1)).alias("total_rows"),
    )
    return counts.withColumn(
        "negative_pct", percent("negative_rows", "total_rows")
    )


def drop_nulls(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.na.drop(subset=list(columns))


def fill_constants(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    return df.fillna(dict(values))
