"""Small grouped reports over trips, rides and text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from wayfact.functions import conditions, exact, text

# Frequent words left out of the ranking.
STOPWORDS = (
    "the", "and", "of", "to", "a", "i", "my", "in", "you", "is", "that", "not", "with", "this",
    "his", "for", "but", "me", "be", "he", "your", "it", "as", "thou", "so", "him", "have",
    "her", "will", "what", "all", "thy", "are", "by", "we", "no", "do", "shall", "if", "thee",
    "on", "from", "or", "our", "they", "their", "she", "would", "lord", "now", "more", "good",
    "us", "come", "let", "was", "an", "at", "had", "than", "may", "well", "yet", "go", "love",
    "did", "should", "make", "one", "know", "out", "like", "up", "am", "o", "hath", "must",
    "doth",
)


def row_count(name: str = "count") -> Column:
    return F.count(F.lit(1)).alias(name)


def grouped_count(df: DataFrame, *keys: str, name: str = "count") -> DataFrame:
    return df.groupBy(*keys).agg(row_count(name))


def largest(df: DataFrame, measure: str, k: int) -> DataFrame:
    """The k rows with the largest measure; ties follow the other columns."""
    ties = [F.col(name).asc_nulls_last() for name in df.columns if name != measure]
    return df.orderBy(F.col(measure).desc_nulls_last(), *ties).limit(k)


def trips_by_hour(trips: DataFrame, timestamp: str = "pickup_timestamp") -> DataFrame:
    return grouped_count(trips.select(F.hour(timestamp).alias("hour")), "hour")


def busiest_hours(trips: DataFrame, k: int = 5) -> DataFrame:
    return largest(trips_by_hour(trips), "count", k)


def fare_by_passengers(trips: DataFrame) -> DataFrame:
    return (
        trips.groupBy("passenger_count")
        .agg(exact.mean("fare_amount").alias("avg_fare_usd"), row_count("n_trips"))
        .orderBy("passenger_count")
    )


def with_tip_pct(trips: DataFrame) -> DataFrame:
    """Rows with a positive fare and the tip as a percentage of it."""
    return trips.where("fare_amount > 0").withColumn(
        "tip_pct", F.col("tip_amount") / F.col("fare_amount") * F.lit(100)
    )


def tip_by_payment(trips: DataFrame) -> DataFrame:
    return (
        with_tip_pct(trips)
        .groupBy("payment_type")
        .agg(
            exact.mean("tip_pct").alias("avg_tip_pct"),
            exact.mean("tip_amount").alias("avg_tip_usd"),
            row_count("n_trips"),
        )
        .orderBy("payment_type")
    )


def card_tip_by_hour(trips: DataFrame) -> DataFrame:
    return (
        with_tip_pct(trips.where(F.col("payment_type") == conditions.CARD))
        .groupBy(F.hour("pickup_timestamp").alias("hour"))
        .agg(exact.mean("tip_pct").alias("avg_tip_pct"), row_count("n_trips"))
        .orderBy("hour")
    )


def with_payment_label(trips: DataFrame) -> DataFrame:
    return trips.withColumn("payment_label", conditions.payment_label(F.col("payment_type")))


def revenue_by_method(trips: DataFrame) -> DataFrame:
    return (
        with_payment_label(trips)
        .groupBy("payment_label")
        .agg(
            row_count("n_trips"),
            exact.sum_of("total_amount", 0).alias("revenue_usd"),
            exact.mean("total_amount").alias("avg_total_usd"),
            exact.mean("fare_amount").alias("avg_fare_usd"),
        )
        .orderBy(F.desc("n_trips"), "payment_label")
    )


def method_by_hour(trips: DataFrame, labels: Sequence[str] = ("credit_card", "cash")) -> DataFrame:
    """Trips per hour with a column per label; null where there are none."""
    return (
        with_payment_label(trips)
        .where(F.col("payment_label").isin(*labels))
        .groupBy(F.hour("pickup_timestamp").alias("hour"))
        .pivot("payment_label", list(labels))
        .agg(F.count(F.lit(1)))
        .orderBy("hour")
    )


def top_zones(joined: DataFrame, k: int = 10) -> DataFrame:
    return largest(grouped_count(joined, "pickup_borough", "pickup_zone"), "count", k)


def fare_by_borough(joined: DataFrame) -> DataFrame:
    return (
        joined.groupBy("pickup_borough")
        .agg(exact.mean("fare_amount").alias("avg_fare_usd"), row_count("n_trips"))
        .orderBy(F.desc("n_trips"), "pickup_borough")
    )


def top_stations(rides: DataFrame, station: str, k: int = 5) -> DataFrame:
    known = rides.where(F.col(station).isNotNull())
    return largest(grouped_count(known, station), "count", k)


def rides_by_type(rides: DataFrame, kind: str, member: str) -> DataFrame:
    return grouped_count(rides, kind, member).orderBy(kind, member)


def no_tip_rate(tip: str) -> Column:
    """Percentage of rows without a tip (aggregate)."""
    return exact.percent(f"count_if({tip} <= 0)", "count(*)")


def global_stats(df: DataFrame, column: str) -> DataFrame:
    value = F.col(column)
    return df.agg(
        row_count("row_count"),
        exact.mean(column).alias("mean"),
        F.min(value).alias("minimum"),
        F.max(value).alias("maximum"),
    )


def word_count(lines: DataFrame, column: str = "value") -> DataFrame:
    """Occurrences of every word in all lines."""
    pieces = lines.select(F.explode(text.words(F.col(column))).alias("word"))
    found = pieces.where(F.length("word") > 0)
    return grouped_count(found, "word")


def top_words(counts: DataFrame, k: int, exclude: Sequence[str] = ()) -> DataFrame:
    kept = counts.where(~F.col("word").isin(*exclude)) if exclude else counts
    return largest(kept, "count", k)
