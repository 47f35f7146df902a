import datetime as dt
import random

import pytest
from pyspark.sql import Window, functions as F

from wayfact.operators import dims

T0 = dt.datetime(2024, 1, 1)
RAW = (
    "STATION string, DATE string, REPORT_TYPE string, HourlyDryBulbTemperature string, "
    "HourlyPrecipitation string, HourlyRelativeHumidity string, HourlyWindSpeed string, "
    "HourlyWindDirection string, HourlyPresentWeatherType string"
)


def report(date, kind, temperature="5.0", amount="0.0", wind="VRB"):
    return ("S", date, kind, temperature, amount, "40", "2.0", wind, None)


def candidates(spark, *rows):
    return dims.hourly_candidates(spark.createDataFrame(rows, RAW))


def test_candidates_keep_usable_reports(spark):
    rows = candidates(
        spark,
        report("2024-01-01T00:51:00", " FM-15 ", "3.9s", "t "),
        report("2024-01-01T00:10:00", "FM-16"),
        report("2024-01-01T00:10:00", "FM-12"),
        report("2024-01-01", "FM-15"),
        report(None, "FM-15"),
    ).collect()
    assert len(rows) == 2
    first = min(rows, key=lambda r: r.report_priority)
    assert (first.report_type, first.temperature_c, first.precipitation_mm) == ("FM-15", 3.9, 0.0)
    assert first.precipitation_trace is True and first.wind_direction_degrees is None
    assert first.weather_hour == T0


def test_best_record(spark):
    best = dims.best_record_per_hour(
        candidates(
            spark,
            report("2024-01-01T00:10:00", "FM-15", "1"),
            report("2024-01-01T00:51:00", "FM-15", "2"),
            report("2024-01-01T00:59:00", "FM-16", "3"),
            report("2024-01-01T01:05:00", "FM-16", "4"),
            report("2024-01-01T02:05:00", "FM-15", "6"),
            report("2024-01-01T02:05:00", "FM-15", "5"),
        )
    )
    # one limit before the shuffle, one after
    plan = best._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert {r.weather_hour.hour: r.temperature_c for r in best.collect()} == {0: 2.0, 1: 4.0, 2: 5.0}


def test_spine_leaves_out_absent_hours(spark):
    first, last = "2024-03-10 00:00:00", "2024-03-10 05:00:00"
    hours = dims.hour_spine(spark, first, last, dims.ABSENT_LOCAL_HOURS)
    assert sorted(r[0].hour for r in hours.collect()) == [0, 1, 3, 4, 5]
    assert dims.hours_between(first, last) == 6
    assert dims.hours_between("2024-01-01 00:00:00", "2024-12-31 23:00:00") == 8784


def series(spark, columns, values):
    rows = [(T0 + dt.timedelta(hours=i), *v) for i, v in enumerate(values)]
    schema = "weather_hour timestamp_ntz, " + ", ".join(f"{c} double" for c in columns)
    return spark.createDataFrame(rows, schema)


def single_window(df, columns):
    """The plain form: one window over the whole axis."""
    order = Window.orderBy("weather_hour")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(1, Window.unboundedFollowing)
    out = df
    for c in columns:
        previous, following = F.last(c, True).over(before), F.first(c, True).over(after)
        out = out.withColumns({f"p_{c}": previous, f"n_{c}": following})
    return out.select(
        "weather_hour",
        *[
            F.when(F.col(c).isNotNull(), F.col(c))
            .when(
                F.col(f"p_{c}").isNotNull() & F.col(f"n_{c}").isNotNull(),
                (F.col(f"p_{c}") + F.col(f"n_{c}")) / 2.0,
            )
            .otherwise(F.coalesce(f"p_{c}", f"n_{c}"))
            .alias(c)
            for c in columns
        ],
        *[F.col(c).isNull().alias(f"{c}_imputed") for c in columns],
    )


@pytest.mark.parametrize("density", [0.02, 0.3, 0.9])
def test_bucketed_fill_equals_single_window(spark, density):
    random.seed(int(density * 100))
    columns = ["a", "b", "c"]
    values = [
        tuple(random.random() if random.random() < density else None for _ in "ab") + (None,)
        for _ in range(24 * 9)
    ]
    df = series(spark, columns, values)
    filled = dims.fill_neighbors(df, columns)
    wanted = single_window(df, columns)
    assert sorted(map(str, filled.select(wanted.columns).collect())) == sorted(
        map(str, wanted.collect())
    )


def test_row_windows_stay_inside_a_bucket(spark):
    df = series(spark, ["a"], [(1.0,), (None,), (3.0,)] * 30)
    plan = dims.fill_neighbors(df, ["a"])._jdf.queryExecution().executedPlan().toString()
    one_task = [i for i, line in enumerate(plan.splitlines()) if "SinglePartition" in line]
    lines = plan.splitlines()
    # the only single-task exchange sits on the per-bucket aggregate
    assert len(one_task) == 1 and "Aggregate" in lines[one_task[0] + 1]


def test_fill_with_station_keys(spark):
    rows = [("x", T0, 1.0), ("x", T0 + dt.timedelta(hours=30), None), ("y", T0, None)]
    df = spark.createDataFrame(rows, "station string, weather_hour timestamp_ntz, a double")
    filled = dims.fill_neighbors(df, ["a"], keys=["station"])
    found = {(r.station, r.weather_hour.day): r.a for r in filled.collect()}
    assert found == {("x", 1): 1.0, ("x", 2): 1.0, ("y", 1): None}


def test_direction(spark):
    columns = ["wind_speed_mps", "wind_direction_degrees"]
    values = [(2.0, None), (0.0, 90.0), (3.0, None), (0.0, None), (1.0, 180.0), (None, None)]
    found = dims.fill_direction(series(spark, columns, values)).orderBy("weather_hour").collect()
    assert [r.wind_direction_degrees for r in found] == [90.0, None, 90.0, None, 180.0, 180.0]
    assert [r.wind_direction_imputed for r in found] == [True, False, True, False, False, None]


def complete(spark):
    observed = dims.best_record_per_hour(
        candidates(
            spark,
            report("2024-01-01T00:51:00", "FM-15", "1.0", "T", "10"),
            report("2024-01-01T03:51:00", "FM-15", "2.0", "", "20"),
        )
    )
    spine = dims.hour_spine(spark, "2024-01-01 00:00:00", "2024-01-01 04:00:00")
    return spine, observed


def test_completed_dimension_and_coverage(spark):
    spine, observed = complete(spark)
    rows = dims.completed_dimension(spine, observed).orderBy("weather_hour").collect()
    assert [r.hour_imputed for r in rows] == [False, True, True, False, True]
    assert [r.temperature_c for r in rows] == [1.0, 1.5, 1.5, 2.0, 2.0]
    assert rows[1].report_type == "IMPUTED" and rows[1].station == dims.DEFAULT_STATION
    assert rows[1].precipitation_trace is False
    parts = dims.Coverage(spine, observed, dims.completed_dimension(spine, observed))
    report_row = dims.coverage_report(parts).first().asDict()
    assert report_row["expected_hours"] == 5 and report_row["observed_rows"] == 2
    assert report_row["missing_hours"] == 3 and report_row["imputed_hours"] == 3
    assert report_row["duplicate_hours"] == 0 and report_row["temperature_c_nulls"] == 0


def test_hour_lookup_has_one_row_per_hour(spark):
    spine, observed = complete(spark)
    hours = dims.completed_dimension(spine, observed)
    assert dims.hour_lookup(hours.unionByName(hours)).count() == 5


def test_daily_rollup(spark):
    schema = (
        "weather_hour timestamp_ntz, temperature_c double, precipitation_mm double, "
        "precipitation_trace boolean, relative_humidity_pct double, wind_speed_mps double, "
        "present_weather string, hour_imputed boolean, weather_condition string"
    )
    rows = [
        (T0, 1.0, 0.5, False, 10.0, 1.0, "b", False, "Rain"),
        (T0 + dt.timedelta(hours=1), 2.0, 3.0, True, 20.0, 2.0, "a", True, "Heavy Rain"),
        (T0 + dt.timedelta(hours=2), None, None, False, None, None, None, False, "Dry"),
        (T0 + dt.timedelta(days=1), 3.0, 0.0, False, 1.0, 1.0, None, False, "Dry"),
    ]
    first, second = (
        dims.daily_from_hourly(spark.createDataFrame(rows, schema)).orderBy("weather_date").collect()
    )
    assert (first.temperature_c, first.precipitation_mm, first.present_weather) == (1.5, 3.5, "a | b")
    assert first.precipitation_trace and first.hour_imputed
    assert (first.weather_condition, second.weather_condition) == ("Heavy Rain", "Dry")
    assert second.present_weather == ""


def test_daily_repair(spark):
    rows = [
        ("2024-01-01", "40", "50", "30", "0.5", "0", "3"),
        ("2024-01-02", None, "60", "50", "", "0.1", "4"),
        ("2024-01-03", None, None, "50", "0.1", "0", None),
        ("bad", "44", "50", "30", "0.1", "x", "5"),
    ]
    raw = spark.createDataFrame(
        rows, "DATE string, TAVG string, TMAX string, TMIN string, PRCP string, SNOW string, AWND string"
    )
    repaired = dims.repair_daily(dims.parse_daily(raw)).collect()
    found = {str(r.weather_date): r for r in repaired}
    second, third = found["2024-01-02"], found["2024-01-03"]
    assert second.avg_temp_f == 55.0 and second.precip_inches == 0.1
    assert (third.avg_temp_f, third.max_temp_f, third.wind_mph) == (44.0, 50.0, 4.0)


def test_duplicates_and_nulls(spark):
    df = spark.createDataFrame([(1, None), (1, 2.0), (2, None)], "k int, x double")
    assert [tuple(r) for r in dims.duplicate_keys(df, "k").collect()] == [(1, 2)]
    assert dims.null_counts(df, ["k", "x"]).first().asDict() == {"k": 0, "x": 2}
