"""Reports over summary tables: shares, changes against a dry baseline, rankings.

The inputs are summaries, so every frame here is small. Averages arrive rounded and
are handled as whole units, which keeps weighted means and differences exact.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from wayfact.functions import calendar, exact
from wayfact.functions.conditions import DRY, REPORT_ORDER, SEASON_ORDER, rank_in
from wayfact.plans.summaries import ALL_MEASURES

# Fixed values.
REPORT_BOROUGHS = ("Bronx", "Brooklyn", "Manhattan", "Queens", "Staten Island")
OTHER_BOROUGHS = ("Unknown", "N/A", "EWR")
OTHER_ZONES = ("Unknown", "N/A")
RUSH, NOT_RUSH = "Rush Hour", "Non-Rush Hour"
AVERAGES = tuple(m.name for m in ALL_MEASURES)


def _condition_rank(column: str = "weather_condition") -> Column:
    return rank_in(F.col(column), REPORT_ORDER)


def _share(count: str, keys: Sequence[str]) -> Column:
    """A row's percentage of its group's total."""
    return exact.percent(count, f"sum({count}) over (partition by {', '.join(keys)})")


def _dry_baseline(summary: DataFrame, keys: Sequence[str], columns: dict[str, str]) -> DataFrame:
    dry = summary.where(F.col("weather_condition") == DRY)
    return dry.select(*keys, *[F.col(c).alias(alias) for c, alias in columns.items()])


def _change(column: str, baseline: str) -> Column:
    return exact.difference(column, baseline)


def period_compare(
    part: DataFrame,
    whole: DataFrame,
    part_name: str = "January 2024",
    whole_name: str = "Full Year 2024",
) -> DataFrame:
    """Condition shares of a part of the data beside those of all of it."""
    both = part.withColumn("analysis_period", F.lit(part_name)).unionByName(
        whole.withColumn("analysis_period", F.lit(whole_name))
    )
    return both.select(
        "analysis_period",
        "weather_condition",
        "trip_count",
        _share("trip_count", ["analysis_period"]).alias("trip_share_pct"),
        *AVERAGES,
    ).orderBy(rank_in(F.col("analysis_period"), (part_name, whole_name)), _condition_rank())


def monthly_shares(monthly: DataFrame) -> DataFrame:
    """Shares within each month of each year."""
    shares = monthly.select(
        "pickup_year",
        "pickup_month",
        "weather_condition",
        "trip_count",
        _share("trip_count", ["pickup_year", "pickup_month"]).alias("monthly_trip_share_pct"),
        *AVERAGES,
    )
    return shares.orderBy("pickup_year", "pickup_month", _condition_rank())


def seasonal_shares(seasonal: DataFrame) -> DataFrame:
    return seasonal.select(
        "season",
        "weather_condition",
        "trip_count",
        _share("trip_count", ["season"]).alias("seasonal_trip_share_pct"),
        *AVERAGES,
    ).orderBy(rank_in(F.col("season"), SEASON_ORDER), _condition_rank())


def _hour_measures() -> list[Column]:
    """Totals and means of hourly rows; the tip rate is averaged without weights."""
    return [
        F.sum("trip_count").alias("total_trips"),
        F.count(F.lit(1)).alias("observed_rows"),
        exact.ratio("sum(trip_count)", "count(*)", 2).alias("avg_trips_per_observed_hour"),
        exact.weighted_mean("avg_fare_amount", "trip_count").alias("weighted_avg_fare_amount"),
        exact.weighted_mean("avg_duration_minutes", "trip_count").alias(
            "weighted_avg_duration_minutes"
        ),
        exact.mean_of_rounded("avg_card_tip_percentage").alias(
            "avg_hourly_card_tip_percentage"
        ),
    ]


def hour_of_day(hourly: DataFrame) -> DataFrame:
    """Demand of each hour of the day by condition."""
    rows = hourly.groupBy("pickup_hour_of_day", "weather_condition").agg(*_hour_measures())
    return rows.select(
        "pickup_hour_of_day",
        "weather_condition",
        "total_trips",
        F.col("observed_rows").alias("observed_date_hours"),
        "avg_trips_per_observed_hour",
        _share("total_trips", ["pickup_hour_of_day"]).alias("hour_weather_share_pct"),
        "weighted_avg_fare_amount",
        "weighted_avg_duration_minutes",
        "avg_hourly_card_tip_percentage",
    ).orderBy("pickup_hour_of_day", _condition_rank())


def borough_impact(borough: DataFrame, boroughs: Sequence[str] = REPORT_BOROUGHS) -> DataFrame:
    """Each borough's conditions against its dry baseline; no baseline, no row."""
    kept = borough.where(F.col("pickup_borough").isin(*boroughs))
    baseline = _dry_baseline(
        kept,
        ["pickup_borough"],
        {
            "avg_fare_amount": "dry_fare",
            "avg_duration_minutes": "dry_duration",
            "avg_card_tip_percentage": "dry_tip",
        },
    )
    shares = kept.withColumn(
        "borough_trip_share_pct", _share("trip_count", ["pickup_borough"])
    )
    return (
        shares.join(baseline, "pickup_borough")
        .select(
            "pickup_borough",
            "weather_condition",
            "trip_count",
            "borough_trip_share_pct",
            "avg_fare_amount",
            _change("avg_fare_amount", "dry_fare").alias("fare_change_vs_dry"),
            "avg_duration_minutes",
            _change("avg_duration_minutes", "dry_duration").alias("duration_change_vs_dry"),
            "avg_card_tip_percentage",
            _change("avg_card_tip_percentage", "dry_tip").alias("tip_pct_change_vs_dry"),
        )
        .orderBy(rank_in(F.col("pickup_borough"), tuple(boroughs)), _condition_rank())
    )


def daily_vs_hourly(hourly: DataFrame, daily: DataFrame) -> DataFrame:
    """How the classes of trips differ between a daily and an hourly join."""
    compared = {
        "avg_fare_amount": ("avg_fare", "fare_difference"),
        "avg_duration_minutes": ("avg_duration", "duration_difference"),
        "avg_card_tip_percentage": ("avg_tip_pct", "tip_pct_difference"),
    }
    kept = {
        "avg_temperature_c": "avg_temperature_c",
        "avg_precipitation_mm": "avg_precipitation_mm",
    }

    def side(summary: DataFrame, name: str) -> DataFrame:
        short = {column: names[0] for column, names in compared.items()} | kept
        return summary.select(
            F.col("weather_condition").alias(f"{name}_condition"),
            F.col("trip_count").alias(f"{name}_trips"),
            *[F.col(column).alias(f"{name}_{out}") for column, out in short.items()],
        )

    left, right = side(hourly, "hourly"), side(daily, "daily")
    joined = left.join(right, F.col("hourly_condition") == F.col("daily_condition"), "full")
    zero = F.lit(0).cast("bigint")
    counts = joined.withColumns(
        {
            "weather_condition": F.coalesce("hourly_condition", "daily_condition"),
            "hourly_trip_count": F.coalesce("hourly_trips", zero),
            "daily_trip_count": F.coalesce("daily_trips", zero),
        }
    )
    # totals over the few condition rows themselves
    everything = Window.partitionBy()
    totals = counts.withColumns(
        {
            "hourly_total": F.sum("hourly_trip_count").over(everything),
            "daily_total": F.sum("daily_trip_count").over(everything),
        }
    )
    hourly_n, daily_n = F.col("hourly_trip_count"), F.col("daily_trip_count")
    hourly_share = "cast(hourly_trip_count as decimal(14,0)) * cast(daily_total as decimal(14,0))"
    daily_share = "cast(daily_trip_count as decimal(14,0)) * cast(hourly_total as decimal(14,0))"
    both = "(cast(hourly_total as decimal(14,0)) * cast(daily_total as decimal(14,0)))"
    shift = exact.percent(f"({daily_share} - {hourly_share})", both)
    measures = []
    for out, change in compared.values():
        measures += [
            F.col(f"hourly_{out}"),
            F.col(f"daily_{out}"),
            _change(f"daily_{out}", f"hourly_{out}").alias(change),
        ]
    for out in kept.values():
        measures += [F.col(f"hourly_{out}"), F.col(f"daily_{out}")]
    return totals.select(
        "weather_condition",
        "hourly_trip_count",
        "daily_trip_count",
        (daily_n - hourly_n).alias("trip_count_difference"),
        exact.percent("hourly_trip_count", "hourly_total").alias("hourly_trip_share_pct"),
        exact.percent("daily_trip_count", "daily_total").alias("daily_trip_share_pct"),
        shift.alias("trip_share_change_pct_points"),
        *measures,
    ).orderBy(_condition_rank())


def intraday_changes(hourly: DataFrame) -> DataFrame:
    """Dates on which more than one condition occurred."""
    names = F.collect_set("weather_condition")
    days = hourly.groupBy("pickup_date").agg(
        F.size(names).cast("bigint").alias("weather_condition_count"),
        F.array_join(F.sort_array(names), ", ").alias("weather_conditions"),
        F.sum("trip_count").alias("total_trips"),
    )
    several = F.col("weather_condition_count") > 1
    totals = days.agg(
        F.struct(
            F.count(F.lit(1)).alias("days"), F.count_if(several).alias("several")
        )
    ).scalar()
    return (
        days.where(several)
        .withColumns(
            {
                "total_days": totals.getField("days"),
                "multi_weather_days": totals.getField("several"),
            }
        )
        .withColumn(
            "multi_weather_day_pct",
            exact.percent("multi_weather_days", "total_days"),
        )
        .orderBy("pickup_date")
    )


def rush_hour(hourly: DataFrame) -> DataFrame:
    """Rush and other hours by condition, against their dry baselines."""
    rush = calendar.is_rush_hour(F.col("pickup_date"), F.col("pickup_hour_of_day"))
    period = F.when(rush, RUSH).otherwise(NOT_RUSH)
    rows = (
        hourly.withColumn("time_period", period)
        .groupBy("time_period", "weather_condition")
        .agg(*_hour_measures())
        .withColumnRenamed("observed_rows", "observed_hour_rows")
    )
    baseline = _dry_baseline(
        rows,
        ["time_period"],
        {
            "avg_trips_per_observed_hour": "dry_trips",
            "weighted_avg_fare_amount": "dry_fare",
            "weighted_avg_duration_minutes": "dry_duration",
            "avg_hourly_card_tip_percentage": "dry_tip",
        },
    )
    return (
        rows.join(baseline, "time_period")
        .select(
            "time_period",
            "weather_condition",
            "total_trips",
            "observed_hour_rows",
            "avg_trips_per_observed_hour",
            _change("avg_trips_per_observed_hour", "dry_trips").alias(
                "trips_per_hour_change_vs_dry"
            ),
            "weighted_avg_fare_amount",
            _change("weighted_avg_fare_amount", "dry_fare").alias("fare_change_vs_dry"),
            "weighted_avg_duration_minutes",
            _change("weighted_avg_duration_minutes", "dry_duration").alias(
                "duration_change_vs_dry"
            ),
            "avg_hourly_card_tip_percentage",
            _change("avg_hourly_card_tip_percentage", "dry_tip").alias("tip_pct_change_vs_dry"),
        )
        .orderBy(rank_in(F.col("time_period"), (RUSH, NOT_RUSH)), _condition_rank())
    )


def monthly_tipping(tipping: DataFrame) -> DataFrame:
    """Monthly card tipping by condition, against the month's dry baseline."""
    month = ["pickup_year", "pickup_month"]
    baseline = _dry_baseline(
        tipping,
        month,
        {
            "avg_tip_amount": "dry_tip",
            "avg_tip_percentage": "dry_rate",
            "no_tip_rate_pct": "dry_none",
        },
    )
    shares = tipping.withColumn(
        "monthly_credit_card_trip_share_pct", _share("credit_card_trip_count", month)
    )
    return (
        shares.join(baseline, month)
        .select(
            *month,
            "weather_condition",
            "credit_card_trip_count",
            "monthly_credit_card_trip_share_pct",
            "avg_tip_amount",
            _change("avg_tip_amount", "dry_tip").alias("tip_amount_change_vs_dry"),
            "avg_tip_percentage",
            _change("avg_tip_percentage", "dry_rate").alias("tip_percentage_change_vs_dry"),
            "no_tip_rate_pct",
            _change("no_tip_rate_pct", "dry_none").alias("no_tip_rate_change_vs_dry"),
        )
        .orderBy("pickup_month", _condition_rank(), "pickup_year")
    )


def top_zones(zone: DataFrame, k: int = 10) -> DataFrame:
    """Conditions in the k busiest zones, against each zone's dry baseline."""
    key = ["pickup_borough", "pickup_zone"]
    known = ~F.col("pickup_borough").isin(*OTHER_BOROUGHS) & ~F.col("pickup_zone").isin(
        *OTHER_ZONES
    )
    busiest = (
        zone.where(known)
        .groupBy(*key)
        .agg(F.sum("trip_count").alias("zone_total_trips"))
        .orderBy(F.desc("zone_total_trips"), *key)
        .limit(k)
    )
    baseline = _dry_baseline(
        zone, key, {"avg_fare_amount": "dry_fare", "avg_duration_minutes": "dry_duration"}
    )
    return (
        zone.join(busiest, key)
        .join(baseline, key)
        .select(
            *key,
            "weather_condition",
            "zone_total_trips",
            "trip_count",
            exact.percent("trip_count", "zone_total_trips").alias(
                "zone_weather_trip_share_pct"
            ),
            "avg_fare_amount",
            _change("avg_fare_amount", "dry_fare").alias("fare_change_vs_dry"),
            "avg_duration_minutes",
            _change("avg_duration_minutes", "dry_duration").alias("duration_change_vs_dry"),
        )
        .orderBy(F.desc("zone_total_trips"), *key, _condition_rank())
    )
