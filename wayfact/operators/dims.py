"""Building the hourly and daily condition dimensions."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from wayfact.functions import conditions, exact, text
from wayfact.functions.calendar import hour_start
from wayfact.operators.joins import dedupe, missing_keys

# Fixed values.
REPORT_PRIORITY = {"FM-15": 1, "FM-16": 2}
OBSERVATION_FORMAT = "yyyy-MM-dd'T'HH:mm:ss"
IMPUTED_REPORT = "IMPUTED"
DEFAULT_STATION = "USW00094728"
MEASURES = ("temperature_c", "precipitation_mm", "relative_humidity_pct", "wind_speed_mps")
ABSENT_LOCAL_HOURS = ("2024-03-10 02:00:00",)
NUMERIC_SOURCES = {
    "temperature_c": "HourlyDryBulbTemperature",
    "relative_humidity_pct": "HourlyRelativeHumidity",
    "wind_speed_mps": "HourlyWindSpeed",
    "wind_direction_degrees": "HourlyWindDirection",
}
DAILY_SOURCES = {
    "avg_temp_f": "TAVG",
    "max_temp_f": "TMAX",
    "min_temp_f": "TMIN",
    "precip_inches": "PRCP",
    "snow_inches": "SNOW",
    "wind_mph": "AWND",
}
HOUR_COLUMNS = (
    "weather_hour",
    "temperature_c",
    "precipitation_mm",
    "precipitation_trace",
    "relative_humidity_pct",
    "wind_speed_mps",
    "present_weather",
    "hour_imputed",
)


def hours_between(first: str, last: str) -> int:
    """Number of clock hours from ``first`` to ``last``, both included."""
    span = dt.datetime.fromisoformat(last) - dt.datetime.fromisoformat(first)
    return int(span.total_seconds() // 3600) + 1


def hour_spine(
    spark: SparkSession, first: str, last: str, absent: Sequence[str] = ()
) -> DataFrame:
    """Every clock hour of a period except local hours that never happened."""
    bounds = [F.lit(edge).cast("timestamp_ntz") for edge in (first, last)]
    spine = spark.range(1).select(
        F.explode(F.sequence(*bounds, F.expr("interval 1 hour"))).alias("weather_hour")
    )
    skipped = [F.lit(hour).cast("timestamp_ntz") for hour in absent]
    return spine.where(~F.col("weather_hour").isin(*skipped)) if skipped else spine


def hour_spine_of(times: DataFrame, column: str) -> DataFrame:
    """Every clock hour between the first and the last time found in a table."""
    edges = times.agg(F.min(column).alias("first"), F.max(column).alias("last"))
    return edges.select(
        F.explode(
            F.sequence(
                hour_start(F.col("first")),
                hour_start(F.col("last")),
                F.expr("interval 1 hour"),
            )
        ).alias("weather_hour")
    )


def hourly_candidates(raw: DataFrame) -> DataFrame:
    """Usable station reports with parsed measures, hour and priority."""
    report = F.trim("REPORT_TYPE")
    priority = F.lit(None).cast("int")
    for name, rank in REPORT_PRIORITY.items():
        priority = F.when(report == name, rank).otherwise(priority)
    observed = F.try_to_timestamp("DATE", F.lit(OBSERVATION_FORMAT)).cast("timestamp_ntz")
    amount = F.col("HourlyPrecipitation")
    return (
        raw.where(report.isin(*REPORT_PRIORITY))
        .withColumn("observation_timestamp", observed)
        .where(F.col("observation_timestamp").isNotNull())
        .select(
            F.col("STATION").alias("station"),
            hour_start(F.col("observation_timestamp")).alias("weather_hour"),
            "observation_timestamp",
            report.alias("report_type"),
            priority.alias("report_priority"),
            text.trace_amount(amount).alias("precipitation_mm"),
            text.is_trace(amount).alias("precipitation_trace"),
            *[
                text.numeric_text(F.col(source)).alias(name)
                for name, source in NUMERIC_SOURCES.items()
            ],
            F.col("HourlyPresentWeatherType").alias("present_weather"),
        )
    )


def best_record_per_hour(candidates: DataFrame) -> DataFrame:
    """One report per hour: best priority, then latest, then a fixed order of the rest.

    The filter on the row number lets Spark drop all but one row per hour and
    task before the shuffle, so an hour holding most reports is no burden.
    """
    leading = ("weather_hour", "report_priority", "observation_timestamp")
    ties = [F.col(name).asc_nulls_last() for name in candidates.columns if name not in leading]
    order = Window.partitionBy("weather_hour").orderBy(
        F.col("report_priority").asc(), F.col("observation_timestamp").desc(), *ties
    )
    return (
        candidates.withColumn("_position", F.row_number().over(order))
        .where("_position = 1")
        .drop("_position", "report_priority")
    )


def complete_hours(
    spine: DataFrame, observed: DataFrame, station: str = DEFAULT_STATION
) -> DataFrame:
    """Every hour of the spine with its report, or a flagged empty row."""
    joined = spine.join(observed, "weather_hour", "left")
    return joined.withColumns(
        {
            "hour_imputed": F.col("station").isNull(),
            "station": F.coalesce("station", F.lit(station)),
            "report_type": F.coalesce("report_type", F.lit(IMPUTED_REPORT)),
            "precipitation_trace": F.coalesce("precipitation_trace", F.lit(False)),
        }
    )


def _neighbours(
    df: DataFrame, columns: Sequence[str], order: str, bucket: Column, keys: Sequence[str]
) -> DataFrame:
    """Add the nearest earlier and later non-null value of each column.

    No window spans the whole axis. The axis is cut into buckets; each bucket is
    reduced to its first and last non-null values, the few bucket rows carry values
    across buckets, and the row-level window stays inside one bucket.
    """
    rows = df.withColumn("_bucket", bucket)
    group = [*keys, "_bucket"]
    at = F.col(order)
    edges = rows.groupBy(*group).agg(
        *[F.min_by(c, F.when(F.col(c).isNotNull(), at)).alias(f"_first_{c}") for c in columns],
        *[F.max_by(c, F.when(F.col(c).isNotNull(), at)).alias(f"_last_{c}") for c in columns],
    )
    # these windows see one row per bucket, not per hour
    across = Window.partitionBy(*keys).orderBy("_bucket")
    before = across.rowsBetween(Window.unboundedPreceding, -1)
    after = across.rowsBetween(1, Window.unboundedFollowing)
    carried = edges.select(
        *group,
        *[F.last(f"_last_{c}", True).over(before).alias(f"_in_{c}") for c in columns],
        *[F.first(f"_first_{c}", True).over(after).alias(f"_out_{c}") for c in columns],
    )
    inside = Window.partitionBy(*group).orderBy(order)
    earlier = inside.rowsBetween(Window.unboundedPreceding, -1)
    later = inside.rowsBetween(1, Window.unboundedFollowing)
    return (
        rows.join(carried, group, "left")
        .withColumns(
            {
                **{
                    f"_prev_{c}": F.coalesce(F.last(c, True).over(earlier), f"_in_{c}")
                    for c in columns
                },
                **{
                    f"_next_{c}": F.coalesce(F.first(c, True).over(later), f"_out_{c}")
                    for c in columns
                },
            }
        )
        .drop("_bucket", *[f"_in_{c}" for c in columns], *[f"_out_{c}" for c in columns])
    )


def day_bucket(order: str) -> Column:
    return F.to_date(order)


def fill_neighbors(
    df: DataFrame,
    columns: Sequence[str] = MEASURES,
    order: str = "weather_hour",
    bucket: Column | None = None,
    keys: Sequence[str] = (),
) -> DataFrame:
    """Fill nulls with the midpoint of the nearest observed values, or the only one.

    ``<column>_imputed`` tells which values were filled.
    """
    found = _neighbours(df, columns, order, day_bucket(order) if bucket is None else bucket, keys)
    filled = {}
    for name in columns:
        earlier, later = F.col(f"_prev_{name}"), F.col(f"_next_{name}")
        # the sum is null unless both neighbours exist
        midpoint = (earlier + later) / F.lit(2.0)
        filled[name] = F.coalesce(F.col(name), midpoint, earlier, later)
        filled[f"{name}_imputed"] = F.col(name).isNull()
    return found.withColumns(filled).drop(
        *[f"_prev_{c}" for c in columns], *[f"_next_{c}" for c in columns]
    )


def fill_direction(
    df: DataFrame,
    order: str = "weather_hour",
    bucket: Column | None = None,
    keys: Sequence[str] = (),
) -> DataFrame:
    """Fill the direction from the nearest earlier, else later one; none in a calm."""
    name, speed = "wind_direction_degrees", F.col("wind_speed_mps")
    found = _neighbours(df, [name], order, day_bucket(order) if bucket is None else bucket, keys)
    nearest = F.coalesce(F.col(name), F.col(f"_prev_{name}"), F.col(f"_next_{name}"))
    return found.withColumns(
        {
            "wind_direction_imputed": F.col(name).isNull() & (speed > 0),
            name: F.when(speed == 0, F.lit(None).cast("double")).otherwise(nearest),
        }
    ).drop(f"_prev_{name}", f"_next_{name}")


def completed_dimension(
    spine: DataFrame, observed: DataFrame, station: str = DEFAULT_STATION
) -> DataFrame:
    """Completed hours with filled measures and direction."""
    return fill_direction(fill_neighbors(complete_hours(spine, observed, station)))


def classify_hours(
    hours: DataFrame,
    limits: conditions.HourlyThresholds = conditions.HourlyThresholds(),
) -> DataFrame:
    """Hourly dimension with the condition of each hour."""
    return hours.select(*HOUR_COLUMNS).withColumn(
        "weather_condition",
        conditions.hourly_condition(
            F.col("present_weather"),
            F.col("temperature_c"),
            F.col("precipitation_mm"),
            F.col("precipitation_trace"),
            limits,
        ),
    )


def hour_lookup(
    hours: DataFrame,
    limits: conditions.HourlyThresholds = conditions.HourlyThresholds(),
) -> DataFrame:
    """Classified hours of any origin, reduced to one row per hour."""
    return dedupe(classify_hours(hours, limits), ["weather_hour"])


def daily_from_hourly(hours: DataFrame) -> DataFrame:
    """One row per date; the worst hourly condition names the day."""
    condition = F.col("weather_condition")

    def occurred(name: str) -> Column:
        return F.bool_or(condition == name)

    return hours.groupBy(F.to_date("weather_hour").alias("weather_date")).agg(
        exact.mean("temperature_c", exact.PLACES).alias("temperature_c"),
        exact.sum_of("precipitation_mm", exact.PLACES).alias("precipitation_mm"),
        F.bool_or("precipitation_trace").alias("precipitation_trace"),
        exact.mean("relative_humidity_pct", exact.PLACES).alias("relative_humidity_pct"),
        exact.mean("wind_speed_mps", exact.PLACES).alias("wind_speed_mps"),
        F.array_join(F.sort_array(F.collect_set("present_weather")), " | ").alias(
            "present_weather"
        ),
        F.bool_or("hour_imputed").alias("hour_imputed"),
        conditions.worst_condition(
            occurred(conditions.SNOW), occurred(conditions.HEAVY_RAIN), occurred(conditions.RAIN)
        ).alias("weather_condition"),
    )


def parse_daily(raw: DataFrame) -> DataFrame:
    """Daily station text to typed columns."""
    return raw.select(
        F.col("DATE").try_cast("date").alias("weather_date"),
        *[F.col(source).try_cast("double").alias(name) for name, source in DAILY_SOURCES.items()],
    )


def repair_daily(days: DataFrame) -> DataFrame:
    """Estimate a missing mean from the extremes, then fill with column medians.

    The medians come from daily rows, whose number is bounded by the calendar, and
    enter as a scalar subquery.
    """
    estimated = days.withColumn(
        "avg_temp_f",
        F.coalesce("avg_temp_f", (F.col("max_temp_f") + F.col("min_temp_f")) / F.lit(2.0)),
    )
    medians = estimated.agg(
        F.struct(
            *[
                F.expr(f"percentile_disc(0.5) within group (order by {name})").alias(name)
                for name in DAILY_SOURCES
            ]
        )
    ).scalar()
    return estimated.withColumns(
        {name: F.coalesce(F.col(name), medians.getField(name)) for name in DAILY_SOURCES}
    )


def classified_days(days: DataFrame, heavy: float = 0.5) -> DataFrame:
    return days.withColumns(
        {
            "weather_condition": conditions.daily_condition(
                F.col("snow_inches"), F.col("precip_inches"), heavy
            ),
            "temperature_bin": conditions.temperature_bin(F.col("avg_temp_f")),
        }
    )


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.agg(*[F.count_if(F.col(name).isNull()).alias(name) for name in columns])


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once, with their counts."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("row_count")).where("row_count > 1")


@dataclass(frozen=True)
class Coverage:
    """Inputs of the coverage report."""

    spine: DataFrame
    observed: DataFrame
    complete: DataFrame


def coverage_report(parts: Coverage, key: str = "weather_hour") -> DataFrame:
    """Expected, observed, duplicate, missing and imputed hours and remaining nulls."""
    measures = (*MEASURES, "wind_direction_degrees")
    expected = parts.spine.agg(F.count(F.lit(1)).alias("expected_hours"))
    # one grouped pass gives both the rows and the repeated hours
    per_hour = parts.observed.groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
    observed = per_hour.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("observed_rows"),
        F.count_if(F.col("rows") > 1).alias("duplicate_hours"),
    )
    missing = missing_keys(parts.spine, parts.observed, key).agg(
        F.count(F.lit(1)).alias("missing_hours")
    )
    complete = parts.complete.agg(
        F.count(F.lit(1)).alias("complete_rows"),
        F.count_if("hour_imputed").alias("imputed_hours"),
        *[F.count_if(F.col(name).isNull()).alias(f"{name}_nulls") for name in measures],
    )
    rows = [part.select(F.struct("*")).scalar() for part in (observed, missing, complete)]
    return expected.select("expected_hours", *[r.alias(f"_{i}") for i, r in enumerate(rows)]).select(
        "expected_hours", "_0.*", "_1.*", "_2.*"
    )
