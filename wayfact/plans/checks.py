"""Validation queries over summaries and joined trips."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F


def _trips(name: str = "summarized_trip_rows", column: str = "trip_count") -> Column:
    return F.sum(column).alias(name)


def period_total(summary: DataFrame) -> DataFrame:
    return summary.agg(_trips())


def coverage(joined: DataFrame) -> DataFrame:
    return joined.agg(
        F.min("pickup_date").alias("first_date"),
        F.max("pickup_date").alias("last_date"),
        F.countDistinct("pickup_month").alias("month_count"),
        F.count(F.lit(1)).alias("joined_trip_rows"),
    )


def condition_total(summary: DataFrame) -> DataFrame:
    return summary.agg(F.count(F.lit(1)).alias("weather_categories"), _trips())


def distinct_total(
    summary: DataFrame,
    column: str,
    distinct_name: str,
    rows_name: str,
    count: str = "trip_count",
    total_name: str = "summarized_trip_rows",
) -> DataFrame:
    """Distinct values of a key, summary rows, and the trips they stand for."""
    return summary.agg(
        F.countDistinct(column).alias(distinct_name),
        F.count(F.lit(1)).alias(rows_name),
        _trips(total_name, count),
    )


def hourly_total(hourly: DataFrame) -> DataFrame:
    return hourly.agg(
        F.min("pickup_date").alias("first_date"),
        F.max("pickup_date").alias("last_date"),
        F.countDistinct("pickup_date").alias("date_count"),
        F.count(F.lit(1)).alias("hourly_weather_rows"),
        _trips(),
    )


def consistency(
    spark, joined: Mapping[str, DataFrame], summaries: Mapping[str, DataFrame]
) -> DataFrame:
    """One row: joined rows and the trips behind each summary, as scalar subqueries."""
    rows = [
        frame.agg(F.count(F.lit(1))).scalar().alias(name) for name, frame in joined.items()
    ]
    sums = [frame.agg(F.sum("trip_count")).scalar().alias(name) for name, frame in summaries.items()]
    return spark.range(1).select(*rows, *sums)
