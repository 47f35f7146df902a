"""The labelled hour by group demand table."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from wayfact.functions import conditions, exact
from wayfact.functions.calendar import WEEKDAY_NAMES, in_rush_hours
from wayfact.session import materialize

# Fixed values.
DEMAND_GROUPS = ("Bronx", "Brooklyn", "Manhattan", "Queens")
HOUR_ATTRIBUTES = (
    "pickup_date",
    "pickup_year",
    "pickup_month",
    "pickup_day_of_week",
    "pickup_hour_of_day",
    "temperature_c",
    "precipitation_mm",
    "precipitation_trace",
    "relative_humidity_pct",
    "wind_speed_mps",
    "present_weather",
    "weather_condition",
)
ATTRIBUTE_DEFAULTS = {
    "weather_condition": "Unknown",
    "present_weather": "",
    "precipitation_trace": False,
}
LAST_TRAIN_MONTH = 9
THRESHOLD_QUANTILE = 0.75
QUANTILE_ACCURACY = 10000
HIGH, NORMAL = "High Demand", "Normal Demand"


def demand_source(joined: DataFrame, start: str, end: str, groups: Sequence[str]) -> DataFrame:
    """Joined trips of a half-open date range and the given groups, only needed columns.

    The year test repeats the range for the folders of a stored table.
    """
    date = F.col("pickup_date")
    years = [dt.date.fromisoformat(edge).year for edge in (start, end)]
    return joined.where(
        F.col("pickup_year").between(*years)
        & (date >= F.lit(start).cast("date"))
        & (date < F.lit(end).cast("date"))
        & F.col("pickup_borough").isin(*groups)
    ).select("pickup_hour", "pickup_borough", *HOUR_ATTRIBUTES)


def _per_hour(source: DataFrame, counts: Sequence[Column] = ()) -> DataFrame:
    """One row per hour with its attributes and some trip counts.

    The attributes are constant within an hour, so the maximum equals any non-null
    value. They are grouping keys of the pass over the trips, which then hashes; a
    maximum of text there would make Spark sort all trips. The second aggregation sees
    about one row per hour.
    """
    names = [f"_count_{i}" for i in range(len(counts))]
    measures = [count.alias(name) for count, name in zip(counts, names)]
    grouped = source.groupBy("pickup_hour", *HOUR_ATTRIBUTES)
    combos = grouped.agg(*measures) if measures else grouped.agg(F.count(F.lit(1)).alias("_rows"))
    return (
        combos.groupBy("pickup_hour")
        .agg(
            *[F.max(name).alias(name) for name in HOUR_ATTRIBUTES],
            *[F.sum(name).alias(name) for name in names],
        )
        .fillna(ATTRIBUTE_DEFAULTS)
    )


def hour_attributes(source: DataFrame) -> DataFrame:
    """The calendar and condition of each hour that has a trip."""
    return _per_hour(source)


def hour_group_grid(hours: DataFrame, groups: Sequence[str]) -> DataFrame:
    """Every hour with every group; the groups are a short literal list."""
    return hours.withColumn("pickup_borough", F.explode(F.array(*[F.lit(g) for g in groups])))


def complete_demand(source: DataFrame, groups: Sequence[str]) -> DataFrame:
    """Trips per hour and group, zero where there were none.

    One pass counts every group of the short literal list beside the hour's
    attributes, so the grid comes out complete without a join.
    """
    hours = _per_hour(source, [F.count_if(F.col("pickup_borough") == g) for g in groups])
    cells = [
        F.struct(F.lit(group).alias("pickup_borough"), F.col(f"_count_{i}").alias("trip_count"))
        for i, group in enumerate(groups)
    ]
    return hours.select("pickup_hour", *HOUR_ATTRIBUTES, F.inline(F.array(*cells)))


def indicator(test: Column) -> Column:
    """1.0 where the test holds, 0.0 where it does not or is unknown."""
    return F.when(test, 1.0).otherwise(0.0)


def demand_indicators(demand: DataFrame) -> DataFrame:
    weekday = F.col("pickup_day_of_week").isin(*WEEKDAY_NAMES)
    condition = F.col("weather_condition")
    return demand.withColumns(
        {
            "is_weekday": indicator(weekday),
            "rush_hour_indicator": indicator(weekday & in_rush_hours(F.col("pickup_hour_of_day"))),
            "snow_indicator": indicator(condition == conditions.SNOW),
            "heavy_rain_indicator": indicator(condition == conditions.HEAVY_RAIN),
            "precipitation_trace_indicator": indicator(F.col("precipitation_trace")),
        }
    )


def time_split(demand: DataFrame, is_train: Column | None = None) -> DataFrame:
    """Earlier rows train, later rows test; by default January to September train."""
    test = F.col("pickup_month") <= LAST_TRAIN_MONTH if is_train is None else is_train
    return demand.withColumn("dataset_split", F.when(test, "train").otherwise("test"))


def demand_thresholds(
    demand: DataFrame,
    quantile: float = THRESHOLD_QUANTILE,
    accuracy: int = QUANTILE_ACCURACY,
) -> DataFrame:
    """Per group, the upper quartile of hourly trips in the training rows."""
    return (
        demand.where("dataset_split = 'train'")
        .groupBy("pickup_borough")
        .agg(
            F.percentile_approx("trip_count", quantile, accuracy)
            .cast("double")
            .alias("high_demand_threshold")
        )
    )


def label_high_demand(demand: DataFrame, thresholds: DataFrame) -> DataFrame:
    """Label hours strictly above their group's threshold.

    There is one threshold per group of the literal group list, so that side is
    always small.
    """
    high = F.col("trip_count") > F.col("high_demand_threshold")
    return demand.join(F.broadcast(thresholds), "pickup_borough").withColumns(
        {"label": indicator(high), "demand_level": F.when(high, HIGH).otherwise(NORMAL)}
    )


def labelled_demand(
    source: DataFrame, groups: Sequence[str], is_train: Column | None = None
) -> DataFrame:
    """The complete labelled table from joined trips.

    Thresholds and labels both read the demand rows, so these are written once.
    """
    demand = time_split(demand_indicators(complete_demand(source, groups)), is_train)
    demand = materialize(demand, "demand")
    return label_high_demand(demand, demand_thresholds(demand))


def label_distribution(labelled: DataFrame) -> DataFrame:
    keys = ("dataset_split", "pickup_borough", "demand_level", "label")
    return (
        labelled.groupBy(*keys)
        .agg(
            F.count(F.lit(1)).alias("row_count"),
            exact.mean("trip_count").alias("avg_trip_count"),
            F.min("trip_count").alias("min_trip_count"),
            F.max("trip_count").alias("max_trip_count"),
        )
        .orderBy("dataset_split", "pickup_borough", "label")
    )


def dataset_summary(labelled: DataFrame) -> DataFrame:
    summary = labelled.groupBy("dataset_split").agg(
        F.count(F.lit(1)).alias("dataset_rows"),
        F.countDistinct("pickup_hour").alias("distinct_hours"),
        F.sum("trip_count").alias("represented_trip_count"),
        F.count_if(F.col("label") == 1.0).alias("high_demand_rows"),
    )
    return summary.withColumn(
        "high_demand_row_pct", exact.percent("high_demand_rows", "dataset_rows")
    )
