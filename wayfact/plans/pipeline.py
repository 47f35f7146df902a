"""Whole jobs: raw files in, dimension, summary, demand and model outputs out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from wayfact.operators import basics, clean, demand, dims, eventlog, joins, models
from wayfact.plans import checks, reports, summaries
from wayfact.session import materialize
from wayfact.sources import catalog, guards, readers, writers

# Fixed values.
RAW_TRIP_COLUMNS = tuple(raw for raw, _, _ in clean.TRIP_COLUMNS)
ZONE_COLUMNS = ("LocationID", "Borough", "Zone", "service_zone")
SUMMARY_NAMES = (*summaries.SUMMARIES, "monthly_tipping_summary")
JOINED = "joined_trips"
DAILY_SUMMARIES = (
    "weather_summary",
    "borough_weather_summary",
    "hourly_demand",
    "zone_weather_summary",
)


def _with_year_month(hours: DataFrame) -> DataFrame:
    return hours.withColumns({"year": F.year("weather_hour"), "month": F.month("weather_hour")})


def prepare_hours(spark: SparkSession, source: str, output: str) -> DataFrame:
    """Station text to one report per hour, stored by year and month."""
    raw = readers.csv_text(spark, source)
    best = dims.best_record_per_hour(dims.hourly_candidates(raw))
    writers.write_partitioned(_with_year_month(best), output, ["year", "month"], rebalance=True)
    return dims.null_counts(spark.read.parquet(output), (*dims.MEASURES, "wind_direction_degrees"))


def hour_gaps(spark: SparkSession, source: str, first: str, last: str) -> DataFrame:
    """Clock hours of a period without a stored report."""
    spine = dims.hour_spine(spark, first, last)
    stored = spark.read.parquet(source).withColumn(
        "weather_hour", F.col("weather_hour").cast("timestamp_ntz")
    )
    return joins.missing_keys(spine, stored, "weather_hour").orderBy("weather_hour")


def complete_hours(
    spark: SparkSession,
    source: str,
    output: str,
    first: str,
    last: str,
    station: str = dims.DEFAULT_STATION,
    absent: Sequence[str] = dims.ABSENT_LOCAL_HOURS,
) -> DataFrame:
    """Fill every hour of a period, store by year and month, return the coverage."""
    spine = dims.hour_spine(spark, first, last, absent)
    observed = spark.read.parquet(source).drop("year", "month")
    complete = dims.completed_dimension(spine, observed, station)
    writers.write_partitioned(_with_year_month(complete), output, ["year", "month"], rebalance=True)
    stored = spark.read.parquet(output)
    return dims.coverage_report(dims.Coverage(spine, observed, stored))


def _fact(
    spark: SparkSession,
    trips: str,
    zones: str,
    start: str,
    end: str,
    limits: clean.HourlyLimits,
) -> DataFrame:
    raw = guards.require_columns(spark.read.parquet(trips), RAW_TRIP_COLUMNS, "Trip dataset")
    lookup = readers.csv_inferred(spark, zones)
    lookup = joins.zone_lookup(guards.require_columns(lookup, ZONE_COLUMNS, "Zone lookup"))
    prepared = clean.prepared_hourly(clean.canonical_trips(raw), start, end, limits)
    return joins.attach_zones(prepared, lookup)


def _hours(spark: SparkSession, path: str) -> DataFrame:
    raw = spark.read.parquet(path)
    guards.require_columns(raw, dims.HOUR_COLUMNS, "Hourly condition dataset")
    hours = raw.withColumn("weather_hour", F.col("weather_hour").cast("timestamp_ntz"))
    return dims.hour_lookup(hours)


def _publish(
    spark: SparkSession, joined: DataFrame, output: str, names: Sequence[str], rebalance: bool
) -> DataFrame:
    """Store the joined trips, then make every summary from one roll-up of the stored rows.

    The join runs once. Its stored columns are the only input of the roll-up, which
    replaces keeping the joined rows in memory for each summary.
    """
    by = ["pickup_year", "pickup_month"]
    path = writers.output_path(output, JOINED)
    writers.write_partitioned(joined.select(*summaries.JOINED_COLUMNS), path, by, rebalance)
    rollup = materialize(summaries.trip_rollup(spark.read.parquet(path)), "rollup")
    for name in names:
        if name == "monthly_tipping_summary":
            table = summaries.tipping_rollup(rollup)
        else:
            table = summaries.summarize_rollup(rollup, name)
        writers.write_parquet(table, output, name)
    return summaries.match_rollup(rollup)


def hourly_summaries(
    spark: SparkSession,
    trips: str,
    zones: str,
    hours: str,
    start: str,
    end: str,
    output: str,
    limits: clean.HourlyLimits = clean.HourlyLimits(),
    rebalance: bool = False,
    explain: bool = False,
) -> DataFrame:
    """Joined trips and the eight summaries; returns the join quality."""
    joined = joins.attach_hourly(_fact(spark, trips, zones, start, end, limits), _hours(spark, hours))
    if explain:
        joined.select(*summaries.JOINED_COLUMNS).explain("formatted")
    return _publish(spark, joined, output, SUMMARY_NAMES, rebalance)


def daily_summaries(
    spark: SparkSession,
    trips: str,
    zones: str,
    hours: str,
    start: str,
    end: str,
    output: str,
    limits: clean.HourlyLimits = clean.HourlyLimits(),
    rebalance: bool = False,
) -> DataFrame:
    """The same with the hourly conditions rolled up to days before the join."""
    days = dims.daily_from_hourly(_hours(spark, hours))
    joined = joins.attach_daily(_fact(spark, trips, zones, start, end, limits), days)
    return _publish(spark, joined, output, DAILY_SUMMARIES, rebalance)


def daily_analysis(
    spark: SparkSession,
    trips: str,
    zones: str,
    days: str,
    first: str,
    last: str,
    output: str,
) -> DataFrame:
    """The daily pipeline from daily station text; returns the quality of its filter."""
    parsed = materialize(dims.parse_daily(readers.csv_text(spark, days)), "daily-rows")
    conditions = dims.classified_days(dims.repair_daily(parsed))
    raw = clean.canonical_trips(readers.parquet(spark, trips, RAW_TRIP_COLUMNS))
    lookup = joins.zone_lookup(readers.csv_inferred(spark, zones))
    kept = clean.clean_daily(raw, first, last)
    joined = joins.attach_daily(joins.attach_zones(kept, lookup), conditions)
    reports = {
        "demand_by_condition": summaries.demand_by_condition(joined),
        "daily_demand": summaries.daily_demand(joined),
        "tipping_by_condition": summaries.tipping_by_condition(joined),
        "borough_by_condition": summaries.borough_by_condition(joined),
    }
    for name, table in reports.items():
        writers.write_parquet(table, output, name)
    within = clean.within_dates(F.col("pickup_date"), first, last) & clean.plausible_daily()
    return clean.quality_report(clean.with_daily_columns(raw), within)


def demand_dataset(
    spark: SparkSession,
    source: str,
    output: str,
    start: str,
    end: str,
    groups: Sequence[str] = demand.DEMAND_GROUPS,
) -> DataFrame:
    """The labelled demand table and its thresholds, distribution and summary."""
    joined = spark.read.parquet(source)
    labelled = demand.labelled_demand(demand.demand_source(joined, start, end, groups), groups)
    path = writers.output_path(output, "ml_dataset")
    writers.write_partitioned(
        labelled, path, ["dataset_split"], rebalance=True, only_present=True
    )
    stored = spark.read.parquet(path)
    writers.write_json(demand.demand_thresholds(stored), output, "demand_thresholds")
    writers.write_json(demand.label_distribution(stored), output, "label_distribution")
    summary = demand.dataset_summary(stored)
    writers.write_json(summary, output, "dataset_summary")
    return summary


def demand_models(
    spark: SparkSession, source: str, output: str, trees: int = 150, depth: int = 12
) -> DataFrame:
    """Fit both classifiers, store metrics, features, confusion rows and models."""
    fitted = models.fit_demand_models(spark.read.parquet(source), trees, depth)
    metrics = models.model_comparison(spark, fitted)
    writers.write_json(metrics, output, "model_metrics")
    writers.write_json(models.runtimes(spark, fitted), output, "model_runtimes")
    writers.write_json(models.feature_weights(spark, fitted), output, "feature_importance")
    writers.write_json(models.confusion_long(metrics), output, "confusion_matrices")
    for fit in fitted:
        folder = fit.name.lower().replace(" ", "_")
        fit.model.write().overwrite().save(writers.output_path(output, f"models/{folder}"))
    return metrics


def score_demand(spark: SparkSession, model: str, source: str, output: str) -> DataFrame:
    """Score demand rows with a stored model; returns the metrics over the rows with a label."""
    scored = models.score_stored(model, spark.read.parquet(source))
    writers.write_parquet(scored, output, "scored_demand")
    stored = spark.read.parquet(writers.output_path(output, "scored_demand"))
    return models.binary_metrics(stored.where("label is not null"), "label", "prediction")


def tip_classifier(spark: SparkSession, trips: str, output: str) -> DataFrame:
    """Fit the tip classifier on raw trips; coefficients, intercept and test area as JSON."""
    raw = guards.require_columns(spark.read.parquet(trips), RAW_TRIP_COLUMNS, "Trip dataset")
    rows = models.tip_target(clean.canonical_trips(raw), models.TIP_KEYS)
    rows = materialize(rows, "tips")
    writers.write_json(models.class_balance(rows, "tipped"), output, "tip_class_balance")
    found = models.fit_tip_classifier(rows)
    writers.write_json(found, output, "tip_classifier")
    return found


def analysis_reports(spark: SparkSession, root: str, output: str, daily: str = "") -> DataFrame:
    """All reports over the stored summaries of one run, as JSON; returns their names and rows.

    With ``daily``, the folder of a daily run, the two runs are compared as well.
    """

    def stored(name: str, folder: str = root) -> DataFrame:
        return spark.read.parquet(writers.output_path(folder, name))

    made = {
        "monthly_shares": reports.monthly_shares(stored("monthly_weather_summary")),
        "seasonal_shares": reports.seasonal_shares(stored("seasonal_weather_summary")),
        "hour_of_day": reports.hour_of_day(stored("hourly_demand")),
        "borough_impact": reports.borough_impact(stored("borough_weather_summary")),
        "intraday_changes": reports.intraday_changes(stored("hourly_demand")),
        "rush_hour": reports.rush_hour(stored("hourly_demand")),
        "monthly_tipping": reports.monthly_tipping(stored("monthly_tipping_summary")),
        "top_zones": reports.top_zones(stored("zone_weather_summary")),
    }
    if daily:
        by_hour, by_day = (stored("weather_summary", folder) for folder in (root, daily))
        made["daily_vs_hourly"] = reports.daily_vs_hourly(by_hour, by_day)
    return _counted(spark, made, output)


def validation_checks(spark: SparkSession, root: str, output: str) -> DataFrame:
    """All checks over the stored joined trips and summaries of one run, as JSON."""

    def stored(name: str) -> DataFrame:
        return spark.read.parquet(writers.output_path(root, name))

    def total(name: str, column: str, distinct: str, rows: str) -> DataFrame:
        return checks.distinct_total(stored(name), column, distinct, rows)

    joined = stored(JOINED)
    made = {
        "check_coverage": checks.coverage(joined),
        "check_condition": checks.condition_total(stored("weather_summary")),
        "check_hourly": checks.hourly_total(stored("hourly_demand")),
        "check_monthly": total("monthly_weather_summary", "pickup_month", "month_count", "summary_rows"),
        "check_seasonal": total("seasonal_weather_summary", "season", "season_count", "summary_rows"),
        "check_borough": total("borough_weather_summary", "pickup_borough", "borough_count", "summary_rows"),
        "check_zone": total("zone_weather_summary", "pickup_zone", "zone_count", "summary_rows"),
        "check_tipping": checks.distinct_total(
            stored("monthly_tipping_summary"),
            "pickup_month",
            "month_count",
            "summary_rows",
            "credit_card_trip_count",
            "summarized_credit_card_trips",
        ),
        "check_consistency": checks.consistency(
            spark,
            {"joined_trip_rows": joined},
            {f"{name}_rows": stored(name) for name in ("weather_summary", "hourly_demand", "monthly_weather_summary")},
        ),
    }
    return _counted(spark, made, output)


def _counted(spark: SparkSession, made: dict[str, DataFrame], output: str) -> DataFrame:
    """Write small results as JSON and count what was written."""
    counts = None
    for name, frame in made.items():
        path = writers.write_json(frame, output, name)
        rows = spark.read.schema(frame.schema).json(path).agg(F.count(F.lit(1)).alias("row_count"))
        rows = rows.select(F.lit(name).alias("name"), "row_count")
        counts = rows if counts is None else counts.unionByName(rows)
    return counts


def validate_schemas(spark: SparkSession, root: str, year: int, pattern: str) -> DataFrame:
    """Check a year's monthly files; raises if any does not fit."""
    report = guards.schema_report(spark, guards.monthly_paths(root, year, pattern))
    guards.require_schemas(report)
    return report


def log_metrics(spark: SparkSession, folder: str, output: str) -> DataFrame:
    """Run metrics of the event logs in a folder, as JSON."""
    metrics = eventlog.event_log_metrics(eventlog.read_event_log(spark, folder))
    writers.write_json(metrics, output, "spark_metrics")
    return metrics


def words(spark: SparkSession, source: str, output: str, k: int = 20) -> DataFrame:
    """Word counts of text files; returns the ranking without frequent words."""
    counts = basics.word_count(readers.text_lines(spark, source))
    path = writers.write_parquet(counts, output, "word_counts")
    return basics.top_words(spark.read.parquet(path), k, basics.STOPWORDS)


def register_outputs(spark: SparkSession, database: str, output: str, names: Sequence[str]) -> None:
    """Catalog tables over a job's outputs; partition folders are recovered."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for name in names:
        path = writers.output_path(output, name)
        catalog.register_table(spark, f"{database}.{name}", path)
        if name == JOINED:
            catalog.recover_partitions(spark, f"{database}.{name}")
