import datetime as dt

import pytest
from pyspark.sql import functions as F

from wayfact.operators import clean, joins
from wayfact.session import RUNTIME_SETTINGS

GOOD = {
    "tpep_pickup_datetime": dt.datetime(2024, 1, 1, 0, 0),
    "tpep_dropoff_datetime": dt.datetime(2024, 1, 1, 0, 10),
    "PULocationID": 1,
    "passenger_count": 1.0,
    "trip_distance": 2.0,
    "payment_type": 1,
    "fare_amount": 10.0,
    "tip_amount": 1.0,
    "total_amount": 12.0,
}
SCHEMA = (
    "tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz, PULocationID int, "
    "passenger_count double, trip_distance double, payment_type int, fare_amount double, "
    "tip_amount double, total_amount double"
)


def raw_trips(spark, *changes):
    rows = [tuple((GOOD | change).values()) for change in changes]
    return spark.createDataFrame(rows, SCHEMA)


def after(minutes):
    return {"tpep_dropoff_datetime": GOOD["tpep_pickup_datetime"] + dt.timedelta(minutes=minutes)}


@pytest.mark.parametrize(
    "change, kept",
    [
        ({}, True),
        (after(1), True),
        (after(0.99), False),
        (after(180), True),
        (after(180.1), False),
        (after(-5), False),
        ({"PULocationID": 0}, False),
        ({"PULocationID": 265}, True),
        ({"PULocationID": 266}, False),
        ({"trip_distance": 0.1}, True),
        ({"trip_distance": 0.09}, False),
        ({"trip_distance": 100.01}, False),
        ({"fare_amount": 0.0}, True),
        ({"fare_amount": 1000.01}, False),
        ({"tip_amount": -0.01}, False),
        ({"total_amount": 2000.0}, True),
        ({"total_amount": -1.0}, False),
        ({"fare_amount": None}, False),
        ({"tpep_dropoff_datetime": None}, False),
        ({"passenger_count": None}, True),
        ({"tpep_pickup_datetime": dt.datetime(2023, 12, 31, 23, 59, 59)}, False),
    ],
)
def test_hourly_bounds(spark, change, kept):
    trips = clean.canonical_trips(raw_trips(spark, change))
    assert clean.clean_hourly(trips, "2024-01-01", "2024-02-01").count() == int(kept)


def test_period_is_half_open(spark):
    end = dt.datetime(2024, 2, 1)
    last = {"tpep_pickup_datetime": end, "tpep_dropoff_datetime": end + dt.timedelta(minutes=5)}
    trips = clean.canonical_trips(raw_trips(spark, {}, last))
    assert clean.clean_hourly(trips, "2024-01-01", "2024-02-01").count() == 1


def test_daily_period_includes_both_dates(spark):
    def at(*day):
        start = dt.datetime(*day)
        end = start + dt.timedelta(minutes=5)
        return {"tpep_pickup_datetime": start, "tpep_dropoff_datetime": end}

    moments = [at(2023, 12, 31, 23, 59), at(2024, 1, 1), at(2024, 1, 31, 23, 59), at(2024, 2, 1)]
    trips = clean.canonical_trips(raw_trips(spark, *moments))
    kept = clean.clean_daily(trips, "2024-01-01", "2024-01-31")
    assert sorted(str(r.pickup_date) for r in kept.collect()) == ["2024-01-01", "2024-01-31"]


@pytest.mark.parametrize(
    "change, kept",
    [
        ({}, True),
        ({"trip_distance": 0.0}, False),
        ({"trip_distance": 100.0}, True),
        ({"fare_amount": 500.0}, True),
        ({"fare_amount": 500.01}, False),
        ({"total_amount": 0.0}, False),
        ({"total_amount": 1000.0}, True),
        (after(240), True),
        (after(241), False),
        ({"PULocationID": 266}, True),
    ],
)
def test_daily_bounds(spark, change, kept):
    trips = clean.canonical_trips(raw_trips(spark, change))
    assert clean.clean_daily(trips, "2024-01-01", "2024-01-31").count() == int(kept)


def test_quality_report_counts_null_as_removed(spark):
    trips = clean.canonical_trips(raw_trips(spark, {}, {"fare_amount": None}, {"fare_amount": 900.0}))
    rows = clean.with_daily_columns(trips)
    assert tuple(clean.quality_report(rows, clean.plausible_daily()).first()) == (3, 1, 2, 66.67)
    assert tuple(clean.quality_report(rows.limit(0), F.lit(True)).first()) == (0, 0, 0, 0.0)


def test_filters_reach_the_scan(spark, tmp_path):
    raw_trips(spark, {}, {}).write.parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    cleaned = clean.clean_hourly(clean.canonical_trips(stored), "2024-01-01", "2024-02-01")
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    try:
        plan = plan_of(cleaned.select("fare_amount"))
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    pushed = plan[plan.index("PushedFilters") :]
    assert "GreaterThanOrEqual(tpep_pickup_datetime" in pushed
    assert "LessThanOrEqual(PULocationID,265)" in pushed
    assert "passenger_count" not in plan[plan.index("ReadSchema") :]


def zones(spark):
    rows = [(1, " Queens ", " A", "x"), (1, "Bronx", "B", "x"), (2, "Bronx", "C", "y")]
    return spark.createDataFrame(rows, "LocationID int, Borough string, Zone string, service_zone string")


def test_lookup_is_trimmed_and_always_keeps_the_same_row(spark):
    found = [
        sorted(map(tuple, joins.zone_lookup(zones(spark).repartition(n)).collect()))
        for n in (1, 2, 5)
    ]
    assert found[0] == [(1, "Bronx", "B", "x"), (2, "Bronx", "C", "y")]
    assert found[0] == found[1] == found[2]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_dedupe_limits_rows_before_the_shuffle(spark):
    plan = plan_of(joins.zone_lookup(zones(spark)))
    assert plan.count("WindowGroupLimit") == 2


def test_join_follows_the_checked_size(spark):
    trips = clean.canonical_trips(raw_trips(spark, {}, {"PULocationID": 2}, {"PULocationID": 77}))
    lookup = joins.zone_lookup(zones(spark))
    small = joins.attach_zones(trips, lookup)
    proven = joins.attach_zones(trips, lookup, max_rows=265)
    large = joins.attach_zones(trips, lookup, limit_bytes=10)
    assert "BroadcastHashJoin" in plan_of(small) and "BroadcastHashJoin" in plan_of(proven)
    assert "SortMergeJoin" in plan_of(large)
    rows = [sorted(map(str, df.collect())) for df in (small, proven, large)]
    assert rows[0] == rows[1] == rows[2] and len(rows[0]) == 3


def test_a_row_bound_does_not_bound_texts(spark):
    fact = spark.range(10).select(F.col("id").alias("k"))
    lookup = spark.range(1000).select(F.col("id").alias("k"), F.repeat(F.lit("x"), 10_000).alias("t"))
    limit = 1_000_000
    assert not joins.may_broadcast(lookup, max_rows=1000, limit_bytes=limit)
    assert "SortMergeJoin" in plan_of(joins.attach(fact, lookup, "k", max_rows=1000, limit_bytes=limit))
    numbers = lookup.select("k", F.length("t").alias("n"))
    assert joins.may_broadcast(numbers, max_rows=1000, limit_bytes=limit)
    assert not joins.may_broadcast(numbers, max_rows=10**9, limit_bytes=limit)


def test_skewed_merge_join_is_split(spark):
    """One key holds nearly all rows; adaptive execution splits it over several tasks."""
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "50KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50KB",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        fact = spark.range(0, 400000, 1, 16).select(
            F.when(F.col("id") % 50 == 0, F.col("id")).otherwise(7).alias("key"),
            F.sha2(F.col("id").cast("string"), 256).alias("payload"),
        )
        pairs = spark.range(0, 400000).select(F.col("id").alias("key"), (F.col("id") * 2).alias("v"))
        lookup = joins.dedupe(pairs, ["key"])
        joined = joins.attach(fact, lookup, "key", limit_bytes=0)
        grouped = joined.groupBy("v").agg(F.count("payload").alias("n"))
        rows = {r.v: r.n for r in grouped.collect()}
        assert rows[14] == 392000 and sum(rows.values()) == 400000
        assert "skew=true" in plan_of(grouped)
    finally:
        for key in settings:
            spark.conf.unset(key)


def test_measured_size_counts_the_texts(spark):
    df = spark.createDataFrame([(1, "é" * 50), (2, None)], "k int, t string")
    assert joins.sized(df)[1] == 2 * 2 * joins.OTHER_BYTES + 100
    assert joins.may_broadcast(df, limit_bytes=164) and not joins.may_broadcast(df, limit_bytes=163)
    assert joins.may_broadcast(df.limit(0), limit_bytes=0)


def test_keys_of_different_names(spark):
    trips = clean.canonical_trips(raw_trips(spark, {}, {"PULocationID": 9}))
    for limit in (0, None):
        rows = joins.attach(
            trips, zones(spark), {"pickup_location_id": "LocationID"}, limit_bytes=limit
        ).collect()
        assert sorted((r.pickup_location_id, r.LocationID or 0) for r in rows) == [(1, 1), (1, 1), (9, 0)]


def test_match_report(spark):
    df = spark.createDataFrame([("a", 1.0), (None, 2.0), ("b", None)], "zone string, t double")
    assert tuple(joins.match_report(df, "zone", "t").first()) == (3, 2, 2, 66.67, 66.67)
    assert tuple(joins.match_report(df.limit(0), "zone", "t").first()) == (0, 0, 0, 0.0, 0.0)


def test_runtime_settings_are_on(spark):
    for key, value in RUNTIME_SETTINGS.items():
        assert spark.conf.get(key) == value
