import datetime as dt
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from wayfact.operators import basics, demand, prep
from wayfact.operators.quantiles import exact_quantiles

PROBABILITIES = [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]


def discrete(values, p):
    ordered = sorted(values)
    return ordered[max(1, math.ceil(p * len(ordered))) - 1]


def shapes():
    random.seed(3)
    yield "uniform", [random.random() for _ in range(3000)]
    yield "one value holds most rows", [7.0] * 2000 + [random.random() for _ in range(1000)]
    yield "far outlier", [random.random() for _ in range(999)] + [1e18]
    yield "negative", [random.gauss(-50, 20) for _ in range(1000)]
    yield "constant", [3.5] * 10
    yield "single", [1.0]
    yield "neighbouring doubles", [1.0, np.nextafter(1.0, 2.0), 1e300, -1e300]
    yield "infinities", [1.0, 2.0, 3.0, math.inf, -math.inf]
    yield "full range", [-1.7e308, 1.7e308, 0.0, 5e-324] * 50
    yield "heavy tail", [10.0 ** random.uniform(-300, 300) for _ in range(2000)]


@pytest.mark.parametrize("name, values", list(shapes()), ids=lambda v: v if isinstance(v, str) else "")
def test_exact_quantiles(spark, name, values):
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "x double")
    expected = [discrete(values, p) for p in PROBABILITIES]
    assert exact_quantiles(df, "x", PROBABILITIES) == expected
    assert exact_quantiles(df, "x", PROBABILITIES, small=20, accuracy=100) == expected


def test_nan_is_no_value_of_a_quantile(spark):
    df = spark.createDataFrame([(math.nan,), (1.0,), (2.0,)], "x double")
    assert exact_quantiles(df, "x", [0.5, 1.0]) == [1.0, 2.0]


def test_quantiles_of_nothing(spark):
    assert exact_quantiles(spark.createDataFrame([], "x double"), "x", [0.5]) == [None]


def test_median_impute_and_bins(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (9.0,), (None,)], "x double")
    assert sorted(r.x for r in prep.median_impute(df, "x").collect()) == [1.0, 2.0, 2.0, 9.0]
    found = {r.x: r.b for r in prep.quartile_bins(df, "x", "b").collect()}
    assert found == {1.0: "Q2_medium", 2.0: "Q4_very_long", 9.0: "Q4_very_long", None: "Q4_very_long"} or (
        found[1.0] in ("Q2_medium", "Q3_long") and found[9.0] == "Q4_very_long"
    )


def test_outliers_lie_strictly_beyond_the_fences(spark):
    values = [1.0, 2.0, 3.0, 4.0, 7.0, 7.01, -2.0, -2.01]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    low, high = (discrete(values, p) for p in (0.25, 0.75))
    reach = 1.5 * (high - low)
    found = {r.x: r.flag for r in prep.iqr_outliers(df, "x", "flag").collect()}
    assert found == {v: v < low - reach or v > high + reach for v in values}


def test_zscore(spark):
    values = [1.25, 2.5, 10.0, 4.75]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    found = {r.x: r.z for r in prep.zscore(df, "x", "z").collect()}
    mean, sd = np.mean(values), np.std(values, ddof=1)
    assert all(abs(found[v] - (v - mean) / sd) < 1e-9 for v in values)
    constant = spark.createDataFrame([(1.0,), (1.0,)], "x double")
    assert [r.z for r in prep.zscore(constant, "x", "z").collect()] == [None, None]


@pytest.mark.parametrize("values", [[1.23456789 + 1e-5 * i for i in range(50)], [1e300, -1e300, 3.0]])
def test_zscore_of_any_scale(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    sd = df.agg(F.stddev_samp("x")).first()[0]
    for r in prep.zscore(df, "x", "z").collect():
        expected = (r.x - sum(values) / len(values)) / sd
        assert r.z == pytest.approx(expected, rel=1e-9, nan_ok=True)


def test_zscore_of_many_large_values(spark):
    df = spark.range(200_000).selectExpr("2.9e7 + id % 7 as x")
    row = prep.zscore(df, "x", "z").agg(F.avg("z"), F.stddev_samp("z")).first()
    assert abs(row[0]) < 1e-6 and abs(row[1] - 1) < 1e-9


def test_one_hot(spark):
    df = spark.createDataFrame([(1,), (2,), (3,), (None,)], "p int")
    rows = prep.one_hot(df, "p", {2: "cash", 3: "free"}, "pay_").collect()
    assert [(r.pay_cash, r.pay_free) for r in rows] == [(0, 0), (1, 0), (0, 1), (None, None)]


def test_word_count(spark):
    lines = [("The cat, the CAT's hat!",), ("",), ("  don't 42 stop ",), (None,)]
    counts = basics.word_count(spark.createDataFrame(lines, "value string"))
    assert {r.word: r["count"] for r in counts.collect()} == {
        "the": 2,
        "cat": 1,
        "cat's": 1,
        "hat": 1,
        "don't": 1,
        "stop": 1,
    }
    top = basics.top_words(counts, 2, ("the",)).collect()
    assert [r.word for r in top] == ["cat", "cat's"]


def test_top_k_breaks_ties_by_the_other_columns(spark):
    df = spark.createDataFrame([("b", 1), ("a", 1), ("c", 2), (None, 1)], "k string, n int")
    assert [r.k for r in basics.largest(df, "n", 3).collect()] == ["c", "a", "b"]
    plan = basics.largest(df, "n", 3)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_pivot_leaves_missing_cells_null(spark):
    rows = [(dt.datetime(2024, 1, 1, 5), 1), (dt.datetime(2024, 1, 1, 6), 3)]
    trips = spark.createDataFrame(rows, "pickup_timestamp timestamp_ntz, payment_type int")
    assert [tuple(r) for r in basics.method_by_hour(trips).collect()] == [(5, 1, None)]


def demand_rows(spark):
    """Three hours; group A is busier than its threshold in one of them."""
    schema = (
        "pickup_hour timestamp_ntz, pickup_borough string, pickup_date date, pickup_year int, "
        "pickup_month int, pickup_day_of_week string, pickup_hour_of_day int, temperature_c double, "
        "precipitation_mm double, precipitation_trace boolean, relative_humidity_pct double, "
        "wind_speed_mps double, present_weather string, weather_condition string"
    )

    def row(hour, group, condition):
        moment = dt.datetime(2024, 1, 8, hour)
        fixed = (moment.date(), 2024, 1, "Monday", hour, 1.0, 0.0, None, 50.0, 2.0, None, condition)
        return (moment, group, *fixed)

    rows = [row(7, "A", "Snow")] * 3 + [row(8, "A", None)] + [row(8, "B", None)] * 2
    rows += [row(12, "A", "Dry")] * 5
    return spark.createDataFrame(rows, schema)


def test_complete_demand_has_every_cell(spark):
    cells = demand.complete_demand(demand_rows(spark), ("A", "B")).collect()
    found = {(r.pickup_hour.hour, r.pickup_borough): r.trip_count for r in cells}
    assert found == {(7, "A"): 3, (7, "B"): 0, (8, "A"): 1, (8, "B"): 2, (12, "A"): 5, (12, "B"): 0}
    plan = demand.complete_demand(demand_rows(spark), ("A",))
    lines = plan._jdf.queryExecution().executedPlan().toString().splitlines()
    # the aggregate nearest the trips hashes, it does not sort them
    assert "HashAggregate" in [line for line in lines if "Aggregate" in line][-1]
    eight = next(r for r in cells if r.pickup_hour.hour == 8)
    assert (eight.weather_condition, eight.present_weather, eight.precipitation_trace) == (
        "Unknown",
        "",
        False,
    )


def test_indicators(spark):
    rows = demand.demand_indicators(demand.complete_demand(demand_rows(spark), ("A",))).collect()
    by_hour = {r.pickup_hour.hour: r for r in rows}
    assert by_hour[7].rush_hour_indicator == 1.0 and by_hour[12].rush_hour_indicator == 0.0
    assert by_hour[7].snow_indicator == 1.0 and by_hour[8].snow_indicator == 0.0
    assert by_hour[7].is_weekday == 1.0 and by_hour[7].precipitation_trace_indicator == 0.0


def test_threshold_uses_training_rows_and_label_is_strict(spark):
    rows = [("A", "train", n) for n in (1, 2, 3, 4)] + [("A", "test", n) for n in (3, 4, 100)]
    df = spark.createDataFrame(rows, "pickup_borough string, dataset_split string, trip_count bigint")
    thresholds = demand.demand_thresholds(df)
    assert [tuple(r) for r in thresholds.collect()] == [("A", 3.0)]
    labelled = demand.label_high_demand(df, thresholds)
    assert {r.trip_count: r.label for r in labelled.collect()} == {
        1: 0.0, 2: 0.0, 3: 0.0, 4: 1.0, 100: 1.0
    }
    summary = {r.dataset_split: r for r in demand.dataset_summary(labelled.withColumn("pickup_hour", F.lit(1))).collect()}
    assert summary["train"].high_demand_rows == 1 and summary["train"].high_demand_row_pct == 25.0
    shares = demand.label_distribution(labelled).collect()
    assert sum(r.row_count for r in shares) == 7


def test_default_split_is_by_month(spark):
    df = spark.createDataFrame([(9,), (10,)], "pickup_month int")
    assert [r.dataset_split for r in demand.time_split(df).collect()] == ["train", "test"]
