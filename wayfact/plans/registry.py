"""Every operator as a named query over the given tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from wayfact.functions import calendar, conditions, text
from wayfact.operators import (
    basics,
    clean,
    demand,
    dims,
    evaluation,
    eventlog,
    joins,
    models,
    prep,
)
from wayfact.plans import checks, reports, summaries
from wayfact.plans.views import (
    DEMAND_GROUPS,
    TRIP_DAILY_LIMITS,
    TRIP_DAYS,
    Views,
)
from wayfact.session import materialize, scratch_path
from wayfact.sources import catalog, guards, readers, writers

Query = Callable[[Views], DataFrame]
QUERIES: dict[str, Query] = {}

WEEK_END = "2024-01-08"
PART, WHOLE = "First week", "All"
TIP_PROBABILITIES = {"p10": 0.1, "p25": 0.25, "p50": 0.5, "p75": 0.75, "p90": 0.9, "p99": 0.99}
GRADIENT_BOUND = 1e-3  # of a loss of about 0.5
HOUR_MEASURES = (*dims.MEASURES, "wind_direction_degrees")


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bound(function: Query):
        return lambda spark, sf_dir: function(Views(spark, sf_dir))

    return {name: bound(function) for name, function in QUERIES.items()}


# sources


@query
def scan_parquet(v: Views) -> DataFrame:
    return readers.parquet(v.spark, v.path("orders"))


@query
def scan_pruned(v: Views) -> DataFrame:
    return readers.parquet(v.spark, v.path("lineitem"), ["l_orderkey", "l_quantity"])


def _orders_by_year(v: Views) -> str:
    path = scratch_path(v.spark, "orders-by-year")
    orders = v.table("orders").withColumn("order_year", F.year("o_orderdate"))
    return writers.write_partitioned(orders, path, ["order_year"], rebalance=True)


@query
def scan_partition_pruned(v: Views) -> DataFrame:
    stored = readers.parquet(v.spark, _orders_by_year(v))
    return stored.where("order_year = 1997").select("order_year", "o_orderkey", "o_totalprice")


@query
def range_generate(v: Views) -> DataFrame:
    numbers = readers.generated(v.spark, v.table("orders").count())
    return numbers.select("id", (F.col("id") * 2).alias("doubled"))


@query
def hour_spine(v: Views) -> DataFrame:
    return dims.hour_spine_of(v.table("events"), "ts")


@query
def schema_report(v: Views) -> DataFrame:
    path = scratch_path(v.spark, "trips-by-year")
    trips = v.trips_raw().withColumn("year", F.year("tpep_pickup_datetime"))
    writers.write_partitioned(trips, path, ["year"], rebalance=True)
    years = readers.parquet(v.spark, path).select("year").distinct().collect()
    return guards.schema_report(v.spark, {str(r.year): f"{path}/year={r.year}" for r in years})


@query
def catalog_table(v: Views) -> DataFrame:
    name = f"events_{uuid.uuid4().hex}"
    table = catalog.register_table(v.spark, name, v.path("events"))
    return table.groupBy("event_type").agg(
        basics.row_count("row_count"), F.max("value").alias("max_value")
    )


@query
def catalog_partitioned_table(v: Views) -> DataFrame:
    name = f"orders_{uuid.uuid4().hex}"
    schema = "o_orderkey bigint, o_totalprice double, order_year int"
    table = catalog.register_table(v.spark, name, _orders_by_year(v), schema, ["order_year"])
    return table.groupBy("order_year").agg(
        basics.row_count("row_count"), F.max("o_totalprice").alias("max_price")
    )


@query
def busiest_hours_sql(v: Views) -> DataFrame:
    name = readers.temp_view(v.canonical_rides(), f"rides_{uuid.uuid4().hex}")
    return v.spark.sql(
        f"""
        SELECT extract(HOUR FROM pickup_timestamp) AS hour, count(*) AS count
        FROM {name} GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5
        """
    )


# sinks


@query
def roundtrip_parquet(v: Views) -> DataFrame:
    root = scratch_path(v.spark, "roundtrip")
    return readers.parquet(v.spark, writers.write_parquet(v.canonical_rides(), root, "rides"))


@query
def roundtrip_partitioned(v: Views) -> DataFrame:
    path = scratch_path(v.spark, "trips-by-month")
    by = ["pickup_year", "pickup_month"]
    writers.write_partitioned(v.trips(), path, by, rebalance=True)
    return readers.parquet(v.spark, path)


@query
def roundtrip_json(v: Views) -> DataFrame:
    small = basics.fare_by_passengers(v.line_trips())
    path = writers.write_json(small, scratch_path(v.spark, "roundtrip"), "fares")
    return v.spark.read.schema(small.schema).json(path)


def _ride_csv(v: Views) -> str:
    path = scratch_path(v.spark, "rides-csv")
    v.ride_file().write.csv(path, header=True)
    return path


def _ride_copy(v: Views) -> DataFrame:
    target = scratch_path(v.spark, "rides-parquet")
    return writers.csv_to_parquet(v.spark, _ride_csv(v), target, readers.RIDE_SCHEMA)


@query
def csv_to_parquet(v: Views) -> DataFrame:
    local = {name: F.col(name).cast("timestamp_ntz") for name in ("started_at", "ended_at")}
    return _ride_copy(v).withColumns(local)


@query
def dynamic_overwrite(v: Views) -> DataFrame:
    """Orders by year; a second write replaces two years, with prices in cents, and adds one."""
    path = _orders_by_year(v)
    by = ["order_year"]
    columns = ["o_orderkey", "o_totalprice", "order_year"]
    before = materialize(writers.files_of(readers.parquet(v.spark, path), by), "files")
    orders = v.table("orders").withColumn("order_year", F.year("o_orderdate"))
    changed = orders.where("order_year in (1995, 1996)").withColumn("o_totalprice", F.round(F.col("o_totalprice") * 100))
    added = orders.where("order_year = 1996").withColumn("order_year", F.lit(2096))
    # rows that are written must not be read from the same path
    fresh = materialize(changed.unionByName(added), "changed")
    writers.write_partitioned(fresh, path, by, rebalance=True, only_present=True)
    stored = readers.parquet(v.spark, path)
    kept = writers.files_of(stored, by).join(before, [*by, "file"], "left_semi").select(*by).distinct()
    rows = stored.select(*columns).groupBy(*by).agg(
        basics.row_count("row_count"), F.sum((F.round(F.col("o_totalprice") * 100)).cast("bigint")).alias("units")
    )
    return rows.join(kept.withColumn("files_kept", F.lit(True)), "order_year", "left").na.fill({"files_kept": False})


@query
def csv_quoted_texts(v: Views) -> DataFrame:
    """Whole texts with their line ends and quotes through CSV and back."""
    rows = v.table("documents").select("doc_id", "text", "lang", "source", "n_chars")
    path = writers.write_csv_quoted(rows, scratch_path(v.spark, "documents-csv"))
    stored = readers.csv_quoted(v.spark, path, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    return stored.select("doc_id", F.sha2("text", 256).alias("text_sha256"), "lang", "source", "n_chars")


@query
def csv_inferred_customers(v: Views) -> DataFrame:
    """Customers through CSV, types found by reading it."""
    path = scratch_path(v.spark, "customers-csv")
    v.table("customer").write.csv(path, header=True)
    return readers.csv_inferred(v.spark, path).select(
        F.col("c_custkey").cast("bigint").alias("c_custkey"),
        "c_name",
        "c_acctbal",
        F.typeof("c_acctbal").alias("balance_type"),
        F.typeof("c_name").alias("name_type"),
    )


@query
def csv_text_customers(v: Views) -> DataFrame:
    """Customers through CSV with every column left as text, cast afterwards."""
    path = scratch_path(v.spark, "customers-csv")
    v.table("customer").write.csv(path, header=True)
    stored = readers.csv_text(v.spark, path)
    kinds = F.concat_ws(",", *(F.typeof(c) for c in ("c_custkey", "c_acctbal")))
    return stored.select(
        F.col("c_custkey").cast("bigint").alias("c_custkey"),
        (F.col("c_acctbal").cast("decimal(18,4)") * 2).cast("double").alias("doubled"),
        kinds.alias("kinds"),
    )


@query
def csv_corrupt_lines(v: Views) -> DataFrame:
    """Order lines as CSV, some with a word for a number or a field too few; these are kept whole."""
    n = F.col("l_linenumber")
    quantity = F.when(n == 3, F.lit("many")).otherwise(F.col("l_quantity").cast("int").cast("string"))
    line = F.concat_ws(",", F.col("l_orderkey").cast("string"), quantity, F.when(n != 5, n.cast("string")))
    path = scratch_path(v.spark, "lines-csv")
    v.table("lineitem").select(line.alias("value")).write.text(path)
    schema = "l_orderkey bigint, l_quantity int, l_linenumber int"
    return readers.csv_checked(v.spark, path, schema, header=False)


@query
def text_lines_count(v: Views) -> DataFrame:
    """Texts written as lines and read as such: length of the lines by their first character."""
    path = scratch_path(v.spark, "lines")
    v.table("documents").select(F.col("text").alias("value")).write.text(path)
    lines = readers.text_lines(v.spark, path)
    return lines.groupBy(F.substring("value", 1, 1).alias("first")).agg(
        basics.row_count("line_count"), F.sum(F.length("value")).cast("bigint").alias("characters")
    )


@query
def storage_footprint(v: Views) -> DataFrame:
    source, target = _ride_csv(v), scratch_path(v.spark, "rides-parquet")
    copy = writers.csv_to_parquet(v.spark, source, target, readers.RIDE_SCHEMA)
    original = readers.csv_declared(v.spark, source)
    sizes = {"csv": writers.footprint(original), "parquet": writers.footprint(copy)}
    return sizes["csv"].withColumn("format", F.lit("csv")).unionByName(
        sizes["parquet"].withColumn("format", F.lit("parquet"))
    )


# projections and filters


@query
def canonical_trips(v: Views) -> DataFrame:
    return v.canonical_trips()


@query
def derive_columns(v: Views) -> DataFrame:
    x = F.col("l_quantity")
    return v.table("lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", (x * x).alias("squared"),
        (x * x * x).alias("cubed"),
    )


@query
def filter_simple(v: Views) -> DataFrame:
    return v.table("lineitem").where("l_quantity > 45").select("l_orderkey", "l_quantity")


@query
def date_range(v: Views) -> DataFrame:
    period = clean.in_period(F.col("o_orderdate"), "1996-01-01", "1997-01-01")
    return v.table("orders").where(period).select("o_orderkey", "o_orderdate")


@query
def clean_trips_hourly(v: Views) -> DataFrame:
    return v.trips()


@query
def clean_trips_daily(v: Views) -> DataFrame:
    return v.daily_trips()


@query
def quality_report(v: Views) -> DataFrame:
    kept = clean.within_dates(F.col("pickup_date"), "1995-01-01", "2001-12-31")
    rows = clean.with_daily_columns(v.canonical_trips())
    return clean.quality_report(rows, kept & clean.plausible_daily(TRIP_DAILY_LIMITS))


@query
def in_list(v: Views) -> DataFrame:
    listed = F.col("event_type").isin("click", "view")
    return v.table("events").groupBy(listed.alias("listed")).agg(basics.row_count("row_count"))


@query
def not_null(v: Views) -> DataFrame:
    known = F.col("temperature_c").isNotNull()
    return v.completed_hours().where(known).select("weather_hour", "temperature_c")


@query
def payment_label(v: Views) -> DataFrame:
    labelled = basics.with_payment_label(v.canonical_trips())
    return basics.grouped_count(labelled, "payment_type", "payment_label", name="row_count")


@query
def refund_share(v: Views) -> DataFrame:
    return clean.refund_share(v.table("customer"), "c_acctbal")


@query
def drop_nulls(v: Views) -> DataFrame:
    kept = clean.drop_nulls(v.candidates(), ["temperature_c", "precipitation_mm"])
    return kept.select("observation_timestamp", "temperature_c", "precipitation_mm")


@query
def fill_constants(v: Views) -> DataFrame:
    filled = clean.fill_constants(
        v.candidates(), {"present_weather": "none", "wind_speed_mps": 0.0}
    )
    return filled.select("observation_timestamp", "present_weather", "wind_speed_mps")


@query
def calendar_fields(v: Views) -> DataFrame:
    orders = v.table("orders")
    fields = calendar.calendar_fields(F.col("o_orderdate"))
    return orders.select("o_orderkey", *[c.alias(name) for name, c in fields.items()])


@query
def duration_minutes(v: Views) -> DataFrame:
    return clean.with_duration(v.canonical_trips()).select(
        "pickup_timestamp", "dropoff_timestamp", "trip_duration_minutes"
    )


@query
def season(v: Views) -> DataFrame:
    month = F.month("o_orderdate")
    rows = v.table("orders").select(month.alias("month"), calendar.season(month).alias("season"))
    return basics.grouped_count(rows, "month", "season", name="row_count")


@query
def card_tip_pct(v: Views) -> DataFrame:
    return clean.with_card_tip(v.canonical_rides()).select(
        "pickup_timestamp", "payment_type", "fare_amount", "tip_amount", "card_tip_percentage"
    )


@query
def rush_hour(v: Views) -> DataFrame:
    rush = calendar.is_rush_hour(F.to_date("ts"), F.hour("ts"))
    return v.table("events").groupBy(rush.alias("is_rush_hour")).agg(
        basics.row_count("row_count")
    )


# joins

ZONE_COLUMNS = ("pickup_borough", "pickup_zone", "pickup_service_zone")
HOUR_COLUMNS = ("weather_condition", "temperature_c", "precipitation_mm")


@query
def enrich_zones(v: Views) -> DataFrame:
    rides = joins.attach_zones(v.rides(), v.ride_zones(), v.lookup_rows("customer"))
    return rides.select("pickup_timestamp", "pickup_location_id", *ZONE_COLUMNS)


@query
def enrich_zones_keys(v: Views) -> DataFrame:
    keys = {"pickup_location_id": "LocationID"}
    rows = v.lookup_rows("supplier")
    joined = joins.attach(v.line_trips(), v.trip_zones_raw(), keys, "left", rows)
    return joined.select("pickup_location_id", "LocationID", "Borough", "Zone", "fare_amount")


@query
def enrich_hourly_condition(v: Views) -> DataFrame:
    return v.conditioned_rides().select("pickup_timestamp", "pickup_hour", *HOUR_COLUMNS)


@query
def enrich_daily_condition(v: Views) -> DataFrame:
    return v.conditioned_rides_daily().select("pickup_timestamp", "pickup_date", *HOUR_COLUMNS)


@query
def enrich_sort_merge(v: Views) -> DataFrame:
    hours = v.hours().withColumnRenamed("weather_hour", "pickup_hour")
    zoned = joins.attach_by_merge(v.rides(), v.ride_zones(), "pickup_location_id")
    joined = joins.attach_by_merge(zoned, hours, "pickup_hour")
    return joined.select("pickup_timestamp", "pickup_location_id", *ZONE_COLUMNS, *HOUR_COLUMNS)


@query
def dedupe_dimension(v: Views) -> DataFrame:
    zones = v.ride_zones_raw()
    doubled = zones.unionByName(zones.withColumn("service_zone", F.lower("service_zone")))
    return joins.zone_lookup(doubled, "bigint")


@query
def missing_hours(v: Views) -> DataFrame:
    return joins.missing_keys(v.spine(), v.observed_hours(), "weather_hour")


@query
def hour_group_grid(v: Views) -> DataFrame:
    spine = dims.hour_spine_of(v.table("events"), "ts")
    return demand.hour_group_grid(spine, DEMAND_GROUPS)


@query
def join_quality(v: Views) -> DataFrame:
    return joins.match_report(v.joined_rides(), "pickup_zone", "temperature_c")


# grouped reports


@query
def trips_by_hour(v: Views) -> DataFrame:
    return basics.trips_by_hour(v.canonical_rides())


@query
def busiest_hours(v: Views) -> DataFrame:
    return basics.busiest_hours(v.canonical_rides())


@query
def fare_by_passengers(v: Views) -> DataFrame:
    return basics.fare_by_passengers(v.line_trips())


@query
def longest_trips(v: Views) -> DataFrame:
    columns = ("trip_distance_miles", "fare_amount", "total_amount")
    return basics.largest(v.line_trips().select(*columns), "trip_distance_miles", 10)


@query
def global_stats(v: Views) -> DataFrame:
    return basics.global_stats(v.table("lineitem"), "l_extendedprice")


@query
def no_tip_rate(v: Views) -> DataFrame:
    return v.canonical_trips().groupBy("payment_type").agg(
        basics.no_tip_rate("tip_amount").alias("no_tip_rate_pct")
    )


@query
def revenue_by_method(v: Views) -> DataFrame:
    return basics.revenue_by_method(v.canonical_trips())


@query
def pivot_method_by_hour(v: Views) -> DataFrame:
    return basics.method_by_hour(v.canonical_rides())


@query
def tip_by_payment(v: Views) -> DataFrame:
    return basics.tip_by_payment(v.canonical_trips())


@query
def card_tip_by_hour(v: Views) -> DataFrame:
    return basics.card_tip_by_hour(v.canonical_rides())


def _zoned_trips(v: Views) -> DataFrame:
    return joins.attach_zones(v.line_trips(), v.trip_zones(), v.lookup_rows("supplier"))


@query
def top_zones(v: Views) -> DataFrame:
    return basics.top_zones(_zoned_trips(v))


@query
def fare_by_borough(v: Views) -> DataFrame:
    return basics.fare_by_borough(_zoned_trips(v))


@query
def top_stations(v: Views) -> DataFrame:
    return basics.top_stations(v.ride_file(), "start_station_name")


@query
def rides_by_type(v: Views) -> DataFrame:
    return basics.rides_by_type(v.ride_file(), "rideable_type", "member_casual")


@query
def null_counts(v: Views) -> DataFrame:
    return dims.null_counts(v.candidates(), HOUR_MEASURES)


@query
def duplicate_hours(v: Views) -> DataFrame:
    return dims.duplicate_keys(v.candidates(), "weather_hour")


@query
def distinct_values(v: Views) -> DataFrame:
    return v.table("orders").select("o_orderpriority").distinct()


def _word_counts(v: Views) -> DataFrame:
    return basics.word_count(v.table("documents"), "text")


@query
def word_count(v: Views) -> DataFrame:
    return _word_counts(v)


@query
def word_top_no_stopwords(v: Views) -> DataFrame:
    return basics.top_words(_word_counts(v), 20, basics.STOPWORDS)


# condition dimensions


@query
def numeric_text(v: Views) -> DataFrame:
    number = text.numeric_text(F.col("HourlyDryBulbTemperature"))
    return v.obs().select("DATE", "HourlyDryBulbTemperature", number.alias("temperature_c"))


@query
def trace_amount(v: Views) -> DataFrame:
    amount = F.col("HourlyPrecipitation")
    return v.obs().select(
        "DATE",
        text.is_trace(amount).alias("precipitation_trace"),
        text.trace_amount(amount).alias("precipitation_mm"),
    )


@query
def hourly_candidates(v: Views) -> DataFrame:
    return v.candidates()


@query
def best_record_per_hour(v: Views) -> DataFrame:
    return dims.best_record_per_hour(v.candidates())


@query
def complete_hours(v: Views) -> DataFrame:
    return v.completed_hours()


@query
def fill_neighbors(v: Views) -> DataFrame:
    flags = [f"{name}_imputed" for name in dims.MEASURES]
    return dims.fill_neighbors(v.completed_hours()).select("weather_hour", *dims.MEASURES, *flags)


@query
def fill_direction(v: Views) -> DataFrame:
    complete = dims.completed_dimension(v.spine(), v.observed_hours())
    return complete.select(
        "weather_hour", "wind_speed_mps", "wind_direction_degrees", "wind_direction_imputed"
    )


@query
def coverage_report(v: Views) -> DataFrame:
    complete = dims.completed_dimension(v.spine(), v.observed_hours())
    return dims.coverage_report(dims.Coverage(v.spine(), v.observed_hours(), complete))


@query
def hourly_condition(v: Views) -> DataFrame:
    return v.hours()


@query
def daily_condition(v: Views) -> DataFrame:
    return v.days()


@query
def repair_then_median(v: Views) -> DataFrame:
    return dims.repair_daily(v.parsed_days())


@query
def daily_condition_simple(v: Views) -> DataFrame:
    return v.day_conditions().select(
        "weather_date", "snow_inches", "precip_inches", "weather_condition"
    )


@query
def temperature_bin(v: Views) -> DataFrame:
    return v.day_conditions().select("weather_date", "avg_temp_f", "temperature_bin")


# preparation


def _sparse_passengers(v: Views) -> DataFrame:
    """Trips whose passenger count is unknown for one of its values."""
    count = F.col("passenger_count")
    return v.line_trips().select(
        F.when(count != 3, count).alias("passenger_count"), "fare_amount"
    )


@query
def median_impute(v: Views) -> DataFrame:
    return prep.median_impute(_sparse_passengers(v), "passenger_count")


@query
def iqr_outliers(v: Views) -> DataFrame:
    rides = v.canonical_rides().select("pickup_timestamp", "fare_amount")
    return prep.iqr_outliers(rides, "fare_amount", "is_fare_outlier")


@query
def zscore(v: Views) -> DataFrame:
    scored = prep.zscore(v.line_trips().select("fare_amount"), "fare_amount", "fare_z")
    return scored.withColumn("fare_z", F.round("fare_z", 6))


@query
def quartile_bins(v: Views) -> DataFrame:
    trips = v.line_trips().select("trip_distance_miles")
    return prep.quartile_bins(trips, "trip_distance_miles", "distance_bin")


@query
def one_hot(v: Views) -> DataFrame:
    levels = {
        code: name for code, name in conditions.PAYMENT_LABELS.items() if code != conditions.CARD
    }
    trips = v.canonical_trips().select("payment_type", "fare_amount")
    return prep.one_hot(trips, "payment_type", levels, "pay_")


@query
def tip_quantiles(v: Views) -> DataFrame:
    card = v.canonical_rides().where(F.col("payment_type") == conditions.CARD)
    return prep.tip_quantiles(basics.with_tip_pct(card), F.col("tip_pct"), TIP_PROBABILITIES)


@query
def event_log_metrics(v: Views) -> DataFrame:
    return eventlog.event_log_metrics(v.log_lines())


# summaries


@query
def condition_summary(v: Views) -> DataFrame:
    return summaries.summarize(v.conditioned_rides(), "weather_summary")


@query
def borough_condition_summary(v: Views) -> DataFrame:
    return v.ride_zone_summary(v.conditioned_rides(), "borough_weather_summary")


@query
def hourly_demand(v: Views) -> DataFrame:
    return summaries.summarize(v.conditioned_rides(), "hourly_demand")


@query
def zone_condition_summary(v: Views) -> DataFrame:
    return v.ride_zone_summary(v.conditioned_rides(), "zone_weather_summary")


@query
def monthly_condition_summary(v: Views) -> DataFrame:
    return summaries.summarize(v.conditioned_trips(), "monthly_weather_summary")


@query
def seasonal_condition_summary(v: Views) -> DataFrame:
    return summaries.summarize(v.conditioned_trips(), "seasonal_weather_summary")


@query
def monthly_borough_summary(v: Views) -> DataFrame:
    return v.trip_zone_summary(v.conditioned_trips(), "monthly_borough_weather_summary")


@query
def monthly_tipping_summary(v: Views) -> DataFrame:
    return summaries.tipping_summary(v.conditioned_trips())


@query
def joined_trips(v: Views) -> DataFrame:
    return v.joined_rides().select(*summaries.JOINED_COLUMNS)


@query
def condition_summary_daily(v: Views) -> DataFrame:
    return summaries.summarize(v.conditioned_rides_daily(), "weather_summary")


@query
def borough_condition_summary_daily(v: Views) -> DataFrame:
    return v.ride_zone_summary(v.conditioned_rides_daily(), "borough_weather_summary")


@query
def hourly_demand_daily(v: Views) -> DataFrame:
    return summaries.summarize(v.conditioned_rides_daily(), "hourly_demand")


@query
def zone_condition_summary_daily(v: Views) -> DataFrame:
    return v.ride_zone_summary(v.conditioned_rides_daily(), "zone_weather_summary")


@query
def demand_by_condition(v: Views) -> DataFrame:
    return summaries.demand_by_condition(v.conditioned_daily_trips())


@query
def daily_demand(v: Views) -> DataFrame:
    return summaries.daily_demand(v.conditioned_daily_trips())


@query
def tipping_by_condition(v: Views) -> DataFrame:
    return summaries.tipping_by_condition(v.conditioned_daily_trips())


@query
def borough_by_condition(v: Views) -> DataFrame:
    trips = joins.attach_zones(v.daily_trips(), v.trip_zones(), v.lookup_rows("supplier"))
    joined = joins.attach_daily(trips, v.day_conditions(), TRIP_DAYS)
    return summaries.borough_by_condition(joined)


# reports


def _rolled(joined: DataFrame) -> DataFrame:
    """One pass over the joined rows, shared by the summaries a report compares."""
    return materialize(summaries.trip_rollup(joined), "rollup")


def _stored_fact(joined: DataFrame, name: str) -> DataFrame:
    """The columns a roll-up reads, stored once: counted and rolled up without another join."""
    columns = {*summaries.ROLLUP_KEYS, *summaries.ROLLUP_COLUMNS, "payment_type"} - {"is_card"}
    return materialize(joined.select(*sorted(columns)), name)


@query
def report_period_compare(v: Views) -> DataFrame:
    rollup = _rolled(v.joined_rides())
    week = rollup.where(F.col("pickup_date") < F.lit(WEEK_END).cast("date"))
    part = summaries.summarize_rollup(week, "weather_summary")
    whole = summaries.summarize_rollup(rollup, "weather_summary")
    return reports.period_compare(part, whole, PART, WHOLE)


@query
def report_monthly(v: Views) -> DataFrame:
    return reports.monthly_shares(monthly_condition_summary(v))


@query
def report_seasonal(v: Views) -> DataFrame:
    return reports.seasonal_shares(seasonal_condition_summary(v))


@query
def report_hourly(v: Views) -> DataFrame:
    return reports.hour_of_day(hourly_demand(v))


@query
def report_borough_impact(v: Views) -> DataFrame:
    summary = materialize(borough_condition_summary(v), "summary")
    return reports.borough_impact(summary, (*DEMAND_GROUPS, "MIDDLE EAST"))


@query
def report_daily_vs_hourly(v: Views) -> DataFrame:
    return reports.daily_vs_hourly(condition_summary(v), condition_summary_daily(v))


@query
def report_intraday_changes(v: Views) -> DataFrame:
    return reports.intraday_changes(materialize(hourly_demand(v), "summary"))


@query
def report_rush_hour(v: Views) -> DataFrame:
    return reports.rush_hour(materialize(hourly_demand(v), "summary"))


@query
def report_monthly_tipping(v: Views) -> DataFrame:
    return reports.monthly_tipping(materialize(monthly_tipping_summary(v), "summary"))


@query
def report_top_zones(v: Views) -> DataFrame:
    return reports.top_zones(materialize(zone_condition_summary(v), "summary"))


# checks


@query
def check_period_total(v: Views) -> DataFrame:
    week = v.conditioned_rides().where(F.col("pickup_date") < F.lit(WEEK_END).cast("date"))
    return checks.period_total(summaries.summarize(week, "weather_summary"))


@query
def check_coverage(v: Views) -> DataFrame:
    return checks.coverage(v.joined_rides())


@query
def check_condition(v: Views) -> DataFrame:
    return checks.condition_total(condition_summary(v))


@query
def check_monthly(v: Views) -> DataFrame:
    return checks.distinct_total(
        monthly_condition_summary(v), "pickup_month", "month_count", "month_weather_combinations"
    )


@query
def check_seasonal(v: Views) -> DataFrame:
    return checks.distinct_total(
        seasonal_condition_summary(v), "season", "season_count", "season_weather_combinations"
    )


@query
def check_hourly(v: Views) -> DataFrame:
    return checks.hourly_total(hourly_demand(v))


@query
def check_borough(v: Views) -> DataFrame:
    return checks.distinct_total(
        borough_condition_summary(v),
        "pickup_borough",
        "borough_count",
        "borough_weather_combinations",
    )


@query
def check_zone(v: Views) -> DataFrame:
    return checks.distinct_total(
        zone_condition_summary(v), "pickup_zone", "zone_count", "zone_weather_combinations"
    )


@query
def check_tipping(v: Views) -> DataFrame:
    return checks.distinct_total(
        monthly_tipping_summary(v),
        "pickup_month",
        "month_count",
        "month_weather_combinations",
        "credit_card_trip_count",
        "summarized_credit_card_trips",
    )


@query
def check_consistency(v: Views) -> DataFrame:
    rides, trips = _stored_fact(v.joined_rides(), "rides"), _stored_fact(v.joined_trips(), "trips")
    ride_rollup, trip_rollup = _rolled(rides), _rolled(trips)
    of = summaries.summarize_rollup
    return checks.consistency(
        v.spark,
        {"joined_ride_rows": rides, "joined_trip_rows": trips},
        {
            "weather_summary_rows": of(ride_rollup, "weather_summary"),
            "hourly_summary_rows": of(ride_rollup, "hourly_demand"),
            "monthly_summary_rows": of(trip_rollup, "monthly_weather_summary"),
            "seasonal_summary_rows": of(trip_rollup, "seasonal_weather_summary"),
        },
    )


# demand and models


@query
def hour_attributes(v: Views) -> DataFrame:
    return demand.hour_attributes(v.demand_source())


@query
def complete_demand(v: Views) -> DataFrame:
    return v.demand_table()


@query
def demand_indicators(v: Views) -> DataFrame:
    return demand.demand_indicators(v.demand_table())


@query
def time_split(v: Views) -> DataFrame:
    rows = demand.time_split(v.demand_table(), v.is_train())
    return rows.select("pickup_hour", "pickup_borough", "dataset_split")


@query
def demand_thresholds(v: Views) -> DataFrame:
    return demand.demand_thresholds(v.split_demand())


@query
def label_high_demand(v: Views) -> DataFrame:
    return v.labelled_demand()


@query
def label_distribution(v: Views) -> DataFrame:
    return demand.label_distribution(v.labelled_demand())


@query
def dataset_summary(v: Views) -> DataFrame:
    return demand.dataset_summary(v.labelled_demand())


@query
def tip_target(v: Views) -> DataFrame:
    return models.tip_target(v.canonical_trips())


@query
def class_balance(v: Views) -> DataFrame:
    return models.class_balance(models.tip_target(v.canonical_trips()), "tipped")


@query
def tip_classifier(v: Views) -> DataFrame:
    return models.fit_tip_classifier(models.tip_target(v.canonical_trips(), models.TIP_KEYS))


@query
def tip_split(v: Views) -> DataFrame:
    rows = models.tip_target(v.canonical_trips(), models.TIP_KEYS)
    return models.class_balance(
        evaluation.keyed_split(rows, models.TIP_KEYS, 0.8, models.SEED), "dataset_split", "tipped"
    )


@query
def areas_under_roc(v: Views) -> DataFrame:
    rows = models.tip_target(v.canonical_trips()).withColumn("high", (F.col("fare_amount") > 40000).cast("int"))
    return evaluation.areas_under_roc(rows, "high", models.TIP_FEATURES)


@query
def binary_metrics(v: Views) -> DataFrame:
    return models.binary_metrics(v.table("labels"), "quality", "toxic")


@query
def confusion_long(v: Views) -> DataFrame:
    metrics = models.binary_metrics(v.table("labels"), "quality", "toxic")
    return models.confusion_long(metrics.withColumn("model", F.lit("labels")))


_FITS: dict[tuple[str, str], tuple[DataFrame, list[models.Fitted]]] = {}


def _demand_fits(v: Views) -> tuple[DataFrame, list[models.Fitted]]:
    """The labelled rows and both fits, made once for all queries over one directory."""
    key = (v.spark.sparkContext.applicationId, v.sf_dir)
    if key not in _FITS:
        labelled = materialize(v.labelled_demand(), "labelled")
        _FITS.clear()
        _FITS[key] = labelled, models.fit_demand_models(labelled)
    return _FITS[key]


@query
def demand_models(v: Views) -> DataFrame:
    return models.model_comparison(v.spark, _demand_fits(v)[1])


@query
def feature_ranking(v: Views) -> DataFrame:
    return models.feature_weights(v.spark, _demand_fits(v)[1])


@query
def ranked_feature_names(v: Views) -> DataFrame:
    """Every model ranks every feature once: the names, and the sum of their ranks."""
    ranks = models.feature_weights(v.spark, _demand_fits(v)[1])
    complete = F.sum("rank").over(Window.partitionBy("model"))
    return ranks.select("model", "feature", complete.alias("rank_sum"))


@query
def permutation_importance(v: Views) -> DataFrame:
    labelled, fitted = _demand_fits(v)
    return models.permutation_ranks(fitted, labelled.where("dataset_split = 'test'"))


@query
def logistic_optimum(v: Views) -> DataFrame:
    labelled, fitted = _demand_fits(v)
    found = models.logistic_optimum(fitted[0], labelled.where("dataset_split = 'train'"))
    return found.select("row_count", "feature_count", (F.col("gradient") < GRADIENT_BOUND).alias("optimal"))


@query
def stored_model_scores(v: Views) -> DataFrame:
    """Every demand row scored by both models as fitted and as stored and loaded again."""
    labelled, fitted = _demand_fits(v)
    found = None
    for fit in fitted:
        path = scratch_path(v.spark, "model")
        fit.model.write().save(path)
        again = models.score_stored(path, labelled).select(*models.DEMAND_KEYS, F.col("probability").alias("again"))
        own = fit.model.transform(labelled).select(*models.DEMAND_KEYS, vector_to_array("probability")[1].alias("own"))
        both = own.join(again, list(models.DEMAND_KEYS), "full")
        rows = both.agg(
            F.count(F.lit(1)).alias("row_count"), F.count_if(F.col("own").eqNullSafe(F.col("again"))).alias("equal_rows")
        ).select(F.lit(fit.name).alias("model"), "*")
        found = rows if found is None else found.unionByName(rows)
    return found


@query
def prepared_features(v: Views) -> DataFrame:
    return models.prepared_features(v.gapped_demand())
