"""Summary tables of joined trips.

Every measure is an exact sum and a count until the last step, so a summary can be
made from the trips or from any finer summary with the same result.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from wayfact.functions import calendar, conditions, exact
from wayfact.operators import joins
from wayfact.operators.basics import no_tip_rate

# The columns of the joined trip table.
JOINED_COLUMNS = (
    "pickup_timestamp",
    "dropoff_timestamp",
    "pickup_hour",
    "pickup_date",
    "pickup_year",
    "pickup_month",
    "pickup_day",
    "pickup_day_of_week",
    "season",
    "pickup_hour_of_day",
    "pickup_location_id",
    "pickup_borough",
    "pickup_zone",
    "pickup_service_zone",
    "passenger_count",
    "trip_distance_miles",
    "trip_duration_minutes",
    "payment_type",
    "fare_amount",
    "tip_amount",
    "total_amount",
    "card_tip_percentage",
    "temperature_c",
    "precipitation_mm",
    "precipitation_trace",
    "relative_humidity_pct",
    "wind_speed_mps",
    "present_weather",
    "hour_imputed",
    "weather_condition",
)


@dataclass(frozen=True)
class Measure:
    """A rounded average of a column."""

    name: str
    column: str
    places: int = 2


FARE = Measure("avg_fare_amount", "fare_amount")
TOTAL = Measure("avg_total_amount", "total_amount")
DURATION = Measure("avg_duration_minutes", "trip_duration_minutes")
DISTANCE = Measure("avg_distance_miles", "trip_distance_miles")
TIP_RATE = Measure("avg_card_tip_percentage", "card_tip_percentage")
TEMPERATURE = Measure("avg_temperature_c", "temperature_c")
PRECIPITATION = Measure("avg_precipitation_mm", "precipitation_mm", 3)
ALL_MEASURES = (FARE, TOTAL, DURATION, DISTANCE, TIP_RATE, TEMPERATURE, PRECIPITATION)


@dataclass(frozen=True)
class Summary:
    """Grouping keys, averaged measures, keys that must be known, output order."""

    keys: tuple[str, ...]
    measures: tuple[Measure, ...]
    known: tuple[str, ...] = ("weather_condition",)
    order: tuple[str, ...] = ("-trip_count",)


SUMMARIES = {
    "weather_summary": Summary(("weather_condition",), ALL_MEASURES),
    "borough_weather_summary": Summary(
        ("pickup_borough", "weather_condition"),
        (FARE, DURATION, TIP_RATE),
        known=("pickup_borough", "weather_condition"),
        order=("pickup_borough", "-trip_count"),
    ),
    "hourly_demand": Summary(
        ("pickup_date", "pickup_hour_of_day", "weather_condition"),
        (FARE, DURATION, TIP_RATE),
        order=("pickup_date", "pickup_hour_of_day"),
    ),
    "zone_weather_summary": Summary(
        ("pickup_borough", "pickup_zone", "weather_condition"),
        (FARE, DURATION),
        known=("pickup_zone", "weather_condition"),
    ),
    "monthly_weather_summary": Summary(
        ("pickup_year", "pickup_month", "weather_condition"),
        (FARE, TOTAL, DISTANCE, DURATION, TIP_RATE, TEMPERATURE, PRECIPITATION),
        order=("pickup_year", "pickup_month", "-trip_count"),
    ),
    "seasonal_weather_summary": Summary(
        ("season", "weather_condition"),
        (FARE, TOTAL, DISTANCE, DURATION, TIP_RATE, TEMPERATURE, PRECIPITATION),
        order=("season", "-trip_count"),
    ),
    "monthly_borough_weather_summary": Summary(
        ("pickup_year", "pickup_month", "pickup_borough", "weather_condition"),
        (FARE, DISTANCE, DURATION, TIP_RATE),
        known=("pickup_borough", "weather_condition"),
        order=("pickup_year", "pickup_month", "pickup_borough", "-trip_count"),
    ),
}
TIPPING_KEYS = ("pickup_year", "pickup_month", "weather_condition")


def _known(columns: Sequence[str]) -> Column:
    test = F.col(columns[0]).isNotNull()
    for name in columns[1:]:
        test = test & F.col(name).isNotNull()
    return test


def _sorted(df: DataFrame, order: Sequence[str], keys: Sequence[str]) -> DataFrame:
    terms = [F.desc(name[1:]) if name.startswith("-") else F.asc(name) for name in order]
    return df.orderBy(*terms, *[F.asc(key) for key in keys])


def summarize(joined: DataFrame, name: str) -> DataFrame:
    """One summary straight from joined trips."""
    plan = SUMMARIES[name]
    averages = [exact.mean(m.column, m.places).alias(m.name) for m in plan.measures]
    grouped = joined.where(_known(plan.known)).groupBy(*plan.keys)
    rows = grouped.agg(F.count(F.lit(1)).alias("trip_count"), *averages)
    return _sorted(rows, plan.order, plan.keys)


def tipping_summary(joined: DataFrame) -> DataFrame:
    """Monthly card tipping by condition."""
    rows = (
        joined.where((F.col("payment_type") == conditions.CARD) & _known(("weather_condition",)))
        .groupBy(*TIPPING_KEYS)
        .agg(
            F.count(F.lit(1)).alias("credit_card_trip_count"),
            exact.mean("tip_amount").alias("avg_tip_amount"),
            exact.mean("card_tip_percentage").alias("avg_tip_percentage"),
            no_tip_rate("tip_amount").alias("no_tip_rate_pct"),
        )
    )
    order = ("pickup_year", "pickup_month", "-credit_card_trip_count")
    return _sorted(rows, order, TIPPING_KEYS)


ROLLUP_KEYS = (
    "pickup_date",
    "pickup_hour_of_day",
    "pickup_borough",
    "pickup_zone",
    "weather_condition",
    "is_card",
)
ROLLUP_COLUMNS = (*[m.column for m in ALL_MEASURES], "tip_amount")


def _partial_sums(columns: Sequence[str]) -> list[Column]:
    sums = []
    for name in columns:
        units = exact.units(name)
        sums += [
            F.expr(f"sum({exact.high_part(units)})").alias(f"{name}_high"),
            F.expr(f"sum({exact.low_part(units)})").alias(f"{name}_low"),
            F.count(name).alias(f"{name}_n"),
            F.expr(exact.unusual(name)).alias(f"{name}_odd"),
        ]
    return sums


def trip_rollup(joined: DataFrame) -> DataFrame:
    """Counts and exact sums at the finest grain any summary needs.

    The trips are read once; each summary then reads these rows instead.
    """
    card = F.coalesce(F.col("payment_type") == conditions.CARD, F.lit(False))
    return (
        joined.withColumn("is_card", card)
        .groupBy(*ROLLUP_KEYS)
        .agg(
            F.count(F.lit(1)).alias("trips"),
            F.count_if(F.col("tip_amount") <= 0).alias("untipped"),
            *_partial_sums(ROLLUP_COLUMNS),
        )
    )


def _rolled_mean(column: str, places: int = 2) -> Column:
    high, low, n, odd = (f"sum({column}_{part})" for part in ("high", "low", "n", "odd"))
    return exact.mean_of_parts(high, low, n, places, odd)


def _with_periods(rollup: DataFrame) -> DataFrame:
    month = F.month("pickup_date")
    return rollup.withColumns(
        {
            "pickup_year": F.year("pickup_date"),
            "pickup_month": month,
            "season": calendar.season(month),
        }
    )


def _finish(partial: DataFrame, plan: Summary) -> DataFrame:
    averages = [_rolled_mean(m.column, m.places).alias(m.name) for m in plan.measures]
    grouped = partial.where(_known(plan.known)).groupBy(*plan.keys)
    rows = grouped.agg(F.sum("trips").alias("trip_count"), *averages)
    return _sorted(rows, plan.order, plan.keys)


def summarize_rollup(rollup: DataFrame, name: str) -> DataFrame:
    """The same summary from the roll-up."""
    return _finish(_with_periods(rollup), SUMMARIES[name])


ZONE_KEYS = ("pickup_borough", "pickup_zone")


def summarize_by_zone(
    trips: DataFrame,
    zones: DataFrame,
    name: str,
    max_rows: int | None = None,
    limit_bytes: int | None = None,
) -> DataFrame:
    """A summary whose keys come from the zone lookup, from trips without zones.

    A small lookup is broadcast to the trips. A large one is joined after the trips
    have been reduced per location, so a location holding a third of all trips has
    become a few rows before anything is shuffled by it.
    """
    zones, size = joins.sized(zones, max_rows)
    if size <= (joins.BROADCAST_LIMIT_BYTES if limit_bytes is None else limit_bytes):
        return summarize(joins.attach_zones(trips, zones, max_rows, limit_bytes), name)
    plan = SUMMARIES[name]
    own = [key for key in plan.keys if key not in ZONE_KEYS]
    located = (
        trips.where(_known([key for key in plan.known if key not in ZONE_KEYS]))
        .groupBy("pickup_location_id", *own)
        .agg(F.count(F.lit(1)).alias("trips"), *_partial_sums([m.column for m in plan.measures]))
    )
    return _finish(joins.attach_zones(located, zones, max_rows, limit_bytes), plan)


def tipping_rollup(rollup: DataFrame) -> DataFrame:
    rows = (
        _with_periods(rollup)
        .where(F.col("is_card") & _known(("weather_condition",)))
        .groupBy(*TIPPING_KEYS)
        .agg(
            F.sum("trips").alias("credit_card_trip_count"),
            _rolled_mean("tip_amount").alias("avg_tip_amount"),
            _rolled_mean("card_tip_percentage").alias("avg_tip_percentage"),
            exact.percent("sum(untipped)", "sum(trips)").alias("no_tip_rate_pct"),
        )
    )
    order = ("pickup_year", "pickup_month", "-credit_card_trip_count")
    return _sorted(rows, order, TIPPING_KEYS)


def match_rollup(rollup: DataFrame) -> DataFrame:
    """Join quality from the roll-up."""
    counts = rollup.agg(
        F.coalesce(F.sum("trips"), F.lit(0)).alias("joined_rows"),
        F.coalesce(
            F.sum(F.when(F.col("pickup_zone").isNotNull(), F.col("trips"))), F.lit(0)
        ).alias("zone_matches"),
        F.coalesce(F.sum("temperature_c_n"), F.lit(0)).alias("condition_matches"),
    )
    zero = F.lit(0.0)
    return counts.withColumns(
        {
            "zone_match_rate_pct": F.coalesce(exact.percent("zone_matches", "joined_rows"), zero),
            "condition_match_rate_pct": F.coalesce(
                exact.percent("condition_matches", "joined_rows"), zero
            ),
        }
    )


def demand_by_condition(joined: DataFrame) -> DataFrame:
    """Daily pipeline: trips and averages per condition."""
    return (
        joined.groupBy("weather_condition")
        .agg(
            F.count(F.lit(1)).alias("trip_count"),
            exact.mean("avg_temp_f").alias("avg_temperature_f"),
            exact.mean("trip_distance_miles").alias("avg_distance_miles"),
            exact.mean("fare_amount").alias("avg_fare_usd"),
            exact.mean("trip_duration_minutes").alias("avg_duration_minutes"),
        )
        .orderBy(F.desc("trip_count"), "weather_condition")
    )


DAY_KEYS = (
    "pickup_date",
    "weather_condition",
    "temperature_bin",
    "avg_temp_f",
    "precip_inches",
    "snow_inches",
)


def daily_demand(joined: DataFrame) -> DataFrame:
    return (
        joined.groupBy(*DAY_KEYS)
        .agg(
            F.count(F.lit(1)).alias("daily_trip_count"),
            exact.mean("fare_amount").alias("avg_fare_usd"),
            exact.mean("trip_duration_minutes").alias("avg_duration_minutes"),
        )
        .orderBy("pickup_date")
    )


def tipping_by_condition(joined: DataFrame) -> DataFrame:
    return (
        joined.where(F.col("payment_type") == conditions.CARD)
        .groupBy("weather_condition")
        .agg(
            F.count(F.lit(1)).alias("credit_card_trips"),
            exact.mean("tip_amount").alias("avg_tip_usd"),
            exact.mean("tip_percentage").alias("avg_tip_percentage"),
            no_tip_rate("tip_amount").alias("no_tip_rate_pct"),
        )
        .orderBy(F.desc("credit_card_trips"), "weather_condition")
    )


def borough_by_condition(joined: DataFrame) -> DataFrame:
    return (
        joined.groupBy("pickup_borough", "weather_condition")
        .agg(
            F.count(F.lit(1)).alias("trip_count"),
            exact.mean("fare_amount").alias("avg_fare_usd"),
            exact.mean("trip_duration_minutes").alias("avg_duration_minutes"),
        )
        .orderBy(F.desc("trip_count"), "pickup_borough", "weather_condition")
    )
