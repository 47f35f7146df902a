import datetime as dt
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from wayfact.functions import calendar, conditions, exact, text


def values(spark, rows, schema, column):
    return [row[0] for row in spark.createDataFrame(rows, schema).select(column).collect()]


@pytest.mark.parametrize("numbers", [[0.1, 0.2, 0.25], [2.345, 2.355], [-1.5, -2.53], [1e9, 0.01]])
def test_mean_is_the_rounded_decimal_mean(spark, numbers):
    df = spark.createDataFrame([(x,) for x in [*numbers, None]], "x double")
    exactly = sum(Decimal(str(x)) for x in numbers) / len(numbers)
    expected = float(exactly.quantize(Decimal("0.01"), ROUND_HALF_UP))
    assert df.agg(exact.mean("x")).first()[0] == expected


def test_mean_does_not_depend_on_partitions(spark):
    df = spark.range(20000).select((F.rand(1) * 1000).alias("x"))
    found = {df.repartition(n).agg(exact.mean("x", 6)).first()[0] for n in (1, 3, 17)}
    assert len(found) == 1


def test_sum_parts_survive_large_and_negative_totals(spark):
    big = 4_000_000_000_000_000_000
    df = spark.createDataFrame([(big,), (big,), (big,), (-7,)], "u bigint")
    assert int(df.agg(F.expr(exact.total("u"))).first()[0]) == 3 * big - 7


@pytest.mark.parametrize(
    "num, den, expected",
    [(1, 3, 0.33), (5, 1000, 0.01), (-5, 1000, -0.01), (4, 1000, 0.0), (7, 0, None), (None, 2, None)],
)
def test_ratio(spark, num, den, expected):
    assert values(spark, [(num, den)], "a bigint, b bigint", exact.ratio("a", "b", 2)) == [expected]


def test_empty_mean_is_null(spark):
    assert spark.createDataFrame([], "x double").agg(exact.mean("x")).first()[0] is None


def test_weighted_and_plain_means(spark):
    df = spark.createDataFrame([(1.25, 1), (2.5, 3)], "v double, n bigint")
    row = df.agg(exact.weighted_mean("v", "n"), exact.mean_of_rounded("v")).first()
    assert tuple(row) == (2.19, 1.88)


def test_numeric_text(spark):
    cases = {"0.05s": 0.05, "-3.9": -3.9, ".5": 0.5, " 12. ": 12.0, "VRB": None, "": None, "  ": None}
    cases |= {"+7": 7.0, "T": None, None: None, "a1b2": 1.0}
    found = values(spark, [(k,) for k in cases], "t string", text.numeric_text(F.col("t")))
    assert found == list(cases.values())


def test_trace(spark):
    rows = [("T",), ("t ",), ("0.3",), ("",), (None,)]
    df = spark.createDataFrame(rows, "t string").select(
        text.is_trace(F.col("t")), text.trace_amount(F.col("t"))
    )
    assert [tuple(r) for r in df.collect()] == [
        (True, 0.0),
        (True, 0.0),
        (False, 0.3),
        (False, None),
        (None, None),
    ]


@pytest.mark.parametrize(
    "words, temperature, amount, trace, expected",
    [
        ("-SN:03", 20.0, 0.0, False, "Snow"),
        ("Light SNOW", None, None, None, "Snow"),
        (None, 1.0, 0.1, False, "Snow"),
        (None, 1.01, 0.1, False, "Rain"),
        (None, 10.0, 2.5, False, "Heavy Rain"),
        (None, 10.0, 2.49, False, "Rain"),
        (None, None, 3.0, None, "Heavy Rain"),
        (None, 0.0, 0.0, False, "Dry"),
        (None, 0.0, None, True, "Rain"),
        (None, None, None, None, "Dry"),
    ],
)
def test_hourly_condition(spark, words, temperature, amount, trace, expected):
    column = conditions.hourly_condition(*[F.col(c) for c in "abcd"])
    schema = "a string, b double, c double, d boolean"
    assert values(spark, [(words, temperature, amount, trace)], schema, column) == [expected]


def test_daily_condition_and_bins(spark):
    rows = [(0.1, 0.0), (0.0, 0.5), (0.0, 0.49), (0.0, 0.0), (None, None)]
    column = conditions.daily_condition(F.col("s"), F.col("p"))
    found = values(spark, rows, "s double, p double", column)
    assert found == ["Snow", "Heavy Rain", "Rain", "Dry", "Dry"]
    bins = conditions.temperature_bin(F.col("t"))
    degrees = [(31.9,), (32.0,), (45.0,), (60.0,), (None,)]
    assert values(spark, degrees, "t double", bins) == ["Freezing", "Cold", "Mild", "Warm", "Warm"]


def test_payment_labels(spark):
    rows = [(1,), (2,), (6,), (9,), (None,)]
    found = values(spark, rows, "c int", conditions.payment_label(F.col("c")))
    assert found == ["credit_card", "cash", "voided", "other", "other"]


def test_card_tip(spark):
    rows = [(1, 2.0, 10.0), (1, 30.0, 10.0), (1, 20.0, 10.0), (1, 1.0, 0.0), (2, 1.0, 10.0)]
    column = conditions.card_tip_percentage(F.col("p"), F.col("t"), F.col("f"))
    found = values(spark, rows, "p int, t double, f double", column)
    assert found == [20.0, None, 200.0, None, None]


def test_calendar(spark):
    moment = dt.datetime(2024, 1, 8, 7, 59, 59)
    df = spark.createDataFrame([(moment,)], "t timestamp_ntz")
    fields = calendar.calendar_fields(F.col("t"))
    row = df.select(*[c.alias(n) for n, c in fields.items()]).first()
    assert row["pickup_hour"] == dt.datetime(2024, 1, 8, 7)
    assert dict(df.select(fields["pickup_hour"].alias("h")).dtypes)["h"] == "timestamp_ntz"
    assert (row["pickup_day_of_week"], row["season"], row["pickup_hour_of_day"]) == (
        "Monday",
        "Winter",
        7,
    )
    seasons = values(spark, [(m,) for m in range(1, 13)], "m int", calendar.season(F.col("m")))
    assert seasons == ["Winter"] * 2 + ["Spring"] * 3 + ["Summer"] * 3 + ["Fall"] * 3 + ["Winter"]


def test_rush_hour(spark):
    monday, saturday = dt.date(2024, 1, 8), dt.date(2024, 1, 6)
    rows = [(monday, 7), (monday, 9), (monday, 10), (monday, 16), (monday, 20), (saturday, 8)]
    column = calendar.is_rush_hour(F.col("d"), F.col("h"))
    found = values(spark, rows, "d date, h int", column)
    assert found == [True, True, False, True, False, False]


@pytest.mark.parametrize(
    "numbers",
    [
        [1.0, float("nan"), 3.0],
        [1.0, float("inf")],
        [float("-inf"), 2.0, None],
        [float("inf"), float("-inf")],
        [1.5, 2.25, None],
        [8e12, 8e12],
        [1e-7, 3e-7],
    ],
)
def test_means_and_sums_are_those_of_avg_and_sum(spark, numbers):
    df = spark.createDataFrame([(x,) for x in numbers], "x double")
    row = df.agg(exact.mean("x"), F.avg("x"), exact.sum_of("x"), F.sum("x")).first()
    assert row[0] == pytest.approx(row[1], abs=0.0051, nan_ok=True)
    assert row[2] == pytest.approx(row[3], abs=0.0051, nan_ok=True)


def test_values_too_large_to_be_exact_raise(spark):
    df = spark.createDataFrame([(1e13,)], "x double")
    with pytest.raises(Exception, match="too large"):
        df.agg(exact.mean("x")).collect()
