"""Whole jobs on small files in the raw shapes."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from test_clean_joins import SCHEMA
from wayfact import jobs
from wayfact.functions import exact
from wayfact.operators.clean import HourlyLimits
from wayfact.plans import checks, pipeline, reports, summaries

FIRST, LAST = "2024-01-01 00:00:00", "2024-01-03 23:00:00"
START, END = "2024-01-01", "2024-01-04"


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("raw")
    random.seed(11)
    lines = ["LocationID,Borough,Zone,service_zone"]
    boroughs = ["Bronx", "Brooklyn", "Manhattan", "Queens", "EWR"]
    lines += [f"{i}, {boroughs[i % 5]},Zone {i},Yellow" for i in range(1, 60)]
    (root / "zones.csv").write_text("\n".join(lines) + "\n")
    header = (
        "STATION,DATE,REPORT_TYPE,HourlyDryBulbTemperature,HourlyPrecipitation,"
        "HourlyRelativeHumidity,HourlyWindSpeed,HourlyWindDirection,HourlyPresentWeatherType"
    )
    reports_text = [header]
    for hour in range(72):
        if hour % 7 == 3:
            continue
        moment = dt.datetime(2024, 1, 1) + dt.timedelta(hours=hour, minutes=51)
        amount = random.choice(["0.0", "T", "0.5", "3.0", ""])
        reports_text.append(
            f"USW1,{moment.isoformat()},FM-15,{random.randint(-3, 9)},{amount},50,{hour % 4},{hour},"
        )
    (root / "station.csv").write_text("\n".join(reports_text) + "\n")
    day_lines = ["DATE,TAVG,TMAX,TMIN,PRCP,SNOW,AWND", "2024-01-01,,50,30,0.6,0,5"]
    day_lines += ["2024-01-02,40,45,31,0.0,1.2,", "2024-01-03,,,28,0.1,0,6"]
    (root / "days.csv").write_text("\n".join(day_lines) + "\n")
    trips = []
    for i in range(3000):
        start = dt.datetime(2024, 1, 1) + dt.timedelta(seconds=random.randint(-3000, 262000))
        end = start + dt.timedelta(seconds=random.randint(-100, 9000))
        fare = round(random.uniform(-5, 90), 2)
        tip = random.choice([0.0, round(random.uniform(0, 30), 2)])
        location = random.choice([7, 7, 7, random.randint(0, 70)])
        trips.append((start, end, location, 1.0, round(random.uniform(0, 20), 2),
                      random.choice([1, 1, 2, 3]), fare, tip, round(fare + tip, 2)))
    spark.createDataFrame(trips, SCHEMA).write.parquet(str(root / "trips"))
    return root


@pytest.fixture(scope="module")
def built(spark, raw):
    """Dimension, hourly and daily outputs, built once."""
    nulls = pipeline.prepare_hours(spark, str(raw / "station.csv"), str(raw / "observed"))
    coverage = pipeline.complete_hours(
        spark, str(raw / "observed"), str(raw / "hours"), FIRST, LAST
    )
    args = (spark, str(raw / "trips"), str(raw / "zones.csv"), str(raw / "hours"), START, END)
    hourly = pipeline.hourly_summaries(*args, str(raw / "hourly"), rebalance=True)
    daily = pipeline.daily_summaries(*args, str(raw / "daily"))
    return {"nulls": nulls, "coverage": coverage, "hourly": hourly, "daily": daily}


def table(spark, raw, kind, name):
    return spark.read.parquet(str(raw / kind / name))


def test_hours_are_complete(spark, raw, built):
    row = built["coverage"].first()
    assert (row.expected_hours, row.complete_rows) == (72, 72)
    assert row.missing_hours == row.imputed_hours == 10
    assert row.temperature_c_nulls == 0 and built["nulls"].first().temperature_c == 0
    gaps = pipeline.hour_gaps(spark, str(raw / "observed"), FIRST, LAST)
    assert gaps.count() == 10
    assert pipeline.hour_gaps(spark, str(raw / "hours"), FIRST, LAST).count() == 0


def test_outputs_agree_with_each_other(spark, raw, built):
    joined = table(spark, raw, "hourly", "joined_trips")
    assert set(joined.columns) == set(summaries.JOINED_COLUMNS)
    names = ("weather_summary", "hourly_demand", "monthly_weather_summary", "seasonal_weather_summary")
    tables = {name: table(spark, raw, "hourly", name) for name in names}
    row = checks.consistency(spark, {"joined": joined}, tables).first()
    assert len(set(row)) == 1 and row.joined > 500
    quality = built["hourly"].first()
    assert quality.joined_rows == row.joined
    assert quality.condition_match_rate_pct == 100.0 and quality.zone_match_rate_pct < 100.0
    assert built["daily"].first().joined_rows == row.joined


@pytest.mark.parametrize("name", sorted(summaries.SUMMARIES))
def test_rolled_summary_equals_direct_one(spark, raw, built, name):
    joined = table(spark, raw, "hourly", "joined_trips")
    direct = summaries.summarize(joined, name)
    stored = table(spark, raw, "hourly", name).select(direct.columns)
    assert direct.exceptAll(stored).count() == stored.exceptAll(direct).count() == 0
    assert stored.count() > 0


def test_rolled_tipping_equals_direct_one(spark, raw, built):
    direct = summaries.tipping_summary(table(spark, raw, "hourly", "joined_trips"))
    stored = table(spark, raw, "hourly", "monthly_tipping_summary").select(direct.columns)
    assert direct.exceptAll(stored).count() == stored.exceptAll(direct).count() == 0


def test_averages_match_plain_ones(spark, raw, built):
    joined = table(spark, raw, "hourly", "joined_trips").where("weather_condition is not null")
    plain = joined.groupBy("weather_condition").agg(
        F.avg("fare_amount").alias("f"), F.avg("trip_duration_minutes").alias("d")
    )
    both = plain.join(table(spark, raw, "hourly", "weather_summary"), "weather_condition").collect()
    assert len(both) >= 3
    for row in both:
        assert abs(row.f - row.avg_fare_amount) <= 0.0051
        assert abs(row.d - row.avg_duration_minutes) <= 0.0051


def test_reports_run_on_stored_tables(spark, raw, built):
    hourly = {n: table(spark, raw, "hourly", n) for n in pipeline.SUMMARY_NAMES}
    daily = table(spark, raw, "daily", "weather_summary")
    impact = reports.borough_impact(hourly["borough_weather_summary"]).collect()
    assert {r.pickup_borough for r in impact} == {"Bronx", "Brooklyn", "Manhattan", "Queens"}
    dry = [r for r in impact if r.weather_condition == "Dry"]
    assert all(r.fare_change_vs_dry == 0.0 for r in dry)
    compared = reports.daily_vs_hourly(hourly["weather_summary"], daily).collect()
    assert sum(r.trip_count_difference for r in compared) == 0
    assert all(r.hourly_trip_count + r.daily_trip_count > 0 for r in compared)
    busiest = reports.top_zones(hourly["zone_weather_summary"], 3).collect()
    assert busiest[0].pickup_zone == "Zone 7" and "EWR" not in {r.pickup_borough for r in busiest}
    shares = reports.monthly_shares(hourly["monthly_weather_summary"]).collect()
    assert abs(sum(r.monthly_trip_share_pct for r in shares) - 100) < 0.05
    changes = reports.intraday_changes(hourly["hourly_demand"]).collect()
    assert all(r.weather_condition_count > 1 for r in changes)
    rush = reports.rush_hour(hourly["hourly_demand"]).collect()
    assert rush[0].time_period == "Rush Hour" and rush[0].weather_condition == "Dry"
    assert reports.monthly_tipping(hourly["monthly_tipping_summary"]).count() > 0


def test_groups_without_a_dry_baseline_are_left_out(spark):
    rows = [("A", "Dry", 5, 1.0, 2.0, None), ("A", "Rain", 5, 1.5, 2.0, 3.0), ("B", "Rain", 1, 1.0, 1.0, 1.0)]
    summary = spark.createDataFrame(
        rows,
        "pickup_borough string, weather_condition string, trip_count bigint, avg_fare_amount double, "
        "avg_duration_minutes double, avg_card_tip_percentage double",
    )
    found = reports.borough_impact(summary, ("A", "B")).collect()
    assert [(r.weather_condition, r.fare_change_vs_dry, r.tip_pct_change_vs_dry) for r in found] == [
        ("Dry", 0.0, None),
        ("Rain", 0.5, None),
    ]


def test_daily_analysis(spark, raw):
    quality = pipeline.daily_analysis(
        spark, str(raw / "trips"), str(raw / "zones.csv"), str(raw / "days.csv"),
        "2024-01-01", "2024-01-03", str(raw / "analysis"),
    ).first()
    demand = table(spark, raw, "analysis", "demand_by_condition")
    assert demand.agg(F.sum("trip_count")).first()[0] == quality.clean_rows
    assert {r.weather_condition for r in demand.collect()} == {"Heavy Rain", "Snow", "Rain"}
    days = table(spark, raw, "analysis", "daily_demand").orderBy("pickup_date").collect()
    assert [(d.avg_temp_f, d.temperature_bin) for d in days] == [
        (40.0, "Cold"), (40.0, "Cold"), (40.0, "Cold")
    ]


def test_demand_dataset(spark, raw, built):
    source = str(raw / "hourly" / "joined_trips")
    summary = pipeline.demand_dataset(spark, source, str(raw / "ml"), START, END)
    rows = {r.dataset_split: r for r in summary.collect()}
    stored = spark.read.parquet(str(raw / "ml" / "ml_dataset"))
    assert rows["train"].dataset_rows == stored.count() == rows["train"].distinct_hours * 4
    kept = table(spark, raw, "hourly", "joined_trips").where("pickup_borough <> 'EWR'").count()
    assert rows["train"].represented_trip_count == kept
    assert spark.read.json(str(raw / "ml" / "demand_thresholds")).count() == 4


def test_demand_reads_only_the_years_it_needs(spark, raw, built):
    from wayfact.operators.demand import demand_source

    joined = table(spark, raw, "hourly", "joined_trips")
    plan = demand_source(joined, START, END, ("Bronx",))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(pickup_year" in plan


def test_outputs_as_tables(spark, raw, built):
    names = [pipeline.JOINED, *pipeline.SUMMARY_NAMES]
    pipeline.register_outputs(spark, "outputs", str(raw / "hourly"), names)
    try:
        total = spark.sql("select sum(trip_count) from outputs.weather_summary").first()[0]
        assert spark.table("outputs.joined_trips").count() == total
        assert spark.sql("show partitions outputs.joined_trips").count() == 1
    finally:
        for name in names:
            spark.sql(f"drop table outputs.{name}")
        spark.sql("drop database outputs")


def test_report_and_check_jobs(spark, raw, built, tmp_path):
    made = pipeline.analysis_reports(spark, str(raw / "hourly"), str(tmp_path / "reports"), str(raw / "daily"))
    rows = {r.name: r.row_count for r in made.collect()}
    assert len(rows) == 9 and all(n > 0 for n in rows.values())
    zones = spark.read.json(str(tmp_path / "reports" / "top_zones"))
    assert rows["top_zones"] == zones.count() == reports.top_zones(table(spark, raw, "hourly", "zone_weather_summary")).count()

    made = pipeline.validation_checks(spark, str(raw / "hourly"), str(tmp_path / "checks"))
    assert {r.row_count for r in made.collect()} == {1} and made.count() == 9
    row = spark.read.json(str(tmp_path / "checks" / "check_consistency")).first()
    assert len(set(row)) == 1 and row.joined_trip_rows == table(spark, raw, "hourly", "joined_trips").count()


def test_model_jobs(spark, raw, built, tmp_path):
    out = str(tmp_path / "tips")
    found = {(r.kind, r.name): r.value for r in pipeline.tip_classifier(spark, str(raw / "trips"), out).collect()}
    assert len(found) == 6 and 0 <= found["metric", "auc"] <= 1
    assert spark.read.json(f"{out}/tip_class_balance").count() == 2

    source = str(raw / "hourly" / "joined_trips")
    pipeline.demand_dataset(spark, source, str(tmp_path), START, END)
    # the test period is one of three days, so rows are dealt anew to have both parts
    labelled = spark.read.parquet(str(tmp_path / "ml_dataset"))
    part = F.when(F.dayofmonth("pickup_date") <= 2, "train").otherwise("test")
    labelled = labelled.withColumn("dataset_split", part)
    labelled.write.parquet(str(tmp_path / "split"))
    metrics = pipeline.demand_models(spark, str(tmp_path / "split"), str(tmp_path / "models"), trees=5, depth=3)
    assert "runtime_seconds" not in metrics.columns
    assert spark.read.json(str(tmp_path / "models" / "model_runtimes")).count() == 2
    wanted = {r.model: r.f1_score for r in metrics.collect()}
    labelled.where("dataset_split = 'test'").write.parquet(str(tmp_path / "test"))
    for name, folder in (("Logistic Regression", "logistic_regression"), ("Random Forest", "random_forest")):
        stored = str(tmp_path / "models" / "models" / folder)
        row = pipeline.score_demand(spark, stored, str(tmp_path / "test"), str(tmp_path / folder)).first()
        assert row.f1_score == wanted[name]


def test_words_and_schema_jobs(spark, raw, tmp_path):
    (tmp_path / "text.txt").write_text("the river the river bank\n")
    top = pipeline.words(spark, str(tmp_path / "text.txt"), str(tmp_path / "out"), 1)
    assert [tuple(r) for r in top.collect()] == [("river", 2)]
    with pytest.raises(RuntimeError, match="12 inputs failed"):
        pipeline.validate_schemas(spark, str(tmp_path), 2024, "nothing/{year}-{month}")


def test_every_job_parses():
    for name, (_, required, optional) in jobs.JOBS.items():
        given = [part for option in required for part in (f"--{option}", "x")]
        options = vars(jobs.parser().parse_args([name, *given]))
        assert set(options) == {"job", *required, *optional}


@pytest.mark.parametrize(
    "name", ["borough_weather_summary", "zone_weather_summary", "monthly_borough_weather_summary"]
)
def test_large_lookup_is_joined_after_reduction(spark, raw, built, name):
    joined = table(spark, raw, "hourly", "joined_trips")
    zones = pipeline.joins.zone_lookup(spark.read.csv(str(raw / "zones.csv"), header=True, inferSchema=True))
    trips = joined.drop("pickup_borough", "pickup_zone", "pickup_service_zone")
    late = summaries.summarize_by_zone(trips, zones, name, limit_bytes=0)
    early = summaries.summarize_by_zone(trips, zones, name)
    plan = late._jdf.queryExecution().executedPlan().toString()
    assert plan.index("SortMergeJoin") < plan.index("partial_count(1)")
    wanted = table(spark, raw, "hourly", name).select(late.columns)
    for found in (late, early):
        assert found.exceptAll(wanted).count() == wanted.exceptAll(found).count() == 0


def test_join_and_rollup_do_not_shuffle_the_trips(spark, raw, built):
    """Between the scan of the trips and the partial aggregate there is no exchange."""
    trips = pipeline._fact(spark, str(raw / "trips"), str(raw / "zones.csv"), START, END, HourlyLimits())
    joined = pipeline.joins.attach_hourly(trips, pipeline._hours(spark, str(raw / "hours")))
    plan = joined.groupBy("weather_condition").agg(exact.mean("fare_amount"))
    lines = plan._jdf.queryExecution().executedPlan().toString().splitlines()
    scan = next(i for i, line in enumerate(lines) if "tpep_pickup" in line and "FileScan" in line)
    depth = lines[scan].index("FileScan")
    above = [line for line in lines[:scan] if len(line) - len(line.lstrip(" :+-")) <= depth]
    spine = [l for l in above if not l.lstrip(" :").startswith("+- Broadcast") ]
    exchanges = [line for line in spine if "Exchange hashpartitioning" in line]
    assert len(exchanges) == 1 and "weather_condition" in exchanges[0]
