"""Joining facts to lookups, with the join chosen from a checked size."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import add, and_

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from wayfact.functions.exact import percent
from wayfact.session import materialize

# A lookup is shipped to every executor only below this size.
BROADCAST_LIMIT_BYTES = 128 * 1024 * 1024
OTHER_BYTES = 16
FIXED_WIDTH = (
    T.NumericType,
    T.BooleanType,
    T.DateType,
    T.TimestampType,
    T.TimestampNTZType,
)


Keys = str | Sequence[str] | Mapping[str, str]


def _text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if not isinstance(f.dataType, FIXED_WIDTH)]


def bytes_of(df: DataFrame) -> Column:
    """Rows times fixed widths plus the real lengths of texts and the like (aggregate)."""
    fixed = F.count(F.lit(1)) * F.lit(OTHER_BYTES * len(df.columns))
    texts = [
        F.col(name) if isinstance(df.schema[name].dataType, T.StringType) else F.to_json(F.struct(name))
        for name in _text_columns(df)
    ]
    return reduce(add, [F.coalesce(F.sum(F.octet_length(text)), F.lit(0)) for text in texts], fixed)


def sized(lookup: DataFrame, max_rows: int | None = None) -> tuple[DataFrame, int]:
    """The lookup and a bound of its bytes.

    ``max_rows`` is a bound the caller can prove, such as the hours of a spine. It is
    enough for columns of fixed width. Otherwise the lookup is stored, measured and read
    from there, so it is computed once.
    """
    if max_rows is not None and not _text_columns(lookup):
        return lookup, max_rows * OTHER_BYTES * len(lookup.columns)
    stored = materialize(lookup, "lookup")
    return stored, stored.agg(bytes_of(stored)).first()[0]


def may_broadcast(
    lookup: DataFrame, max_rows: int | None = None, limit_bytes: int | None = None
) -> bool:
    """Whether a lookup is known to be small; see ``sized``."""
    return sized(lookup, max_rows)[1] <= _limit(limit_bytes)


def _limit(limit_bytes: int | None) -> int:
    return BROADCAST_LIMIT_BYTES if limit_bytes is None else limit_bytes


def _condition(on: Keys) -> list[str] | Column:
    if isinstance(on, str):
        return [on]
    if isinstance(on, Mapping):
        return reduce(and_, [F.col(left) == F.col(right) for left, right in on.items()])
    return list(on)


def attach(
    fact: DataFrame,
    lookup: DataFrame,
    on: Keys,
    how: str = "left",
    max_rows: int | None = None,
    limit_bytes: int | None = None,
) -> DataFrame:
    """Join a fact to a lookup on shared names, or on a map of fact to lookup names.

    A lookup of checked small size is broadcast, and the fact is not shuffled.
    A larger one is joined by sort and merge.
    """
    lookup, size = sized(lookup, max_rows)
    if size <= _limit(limit_bytes):
        return fact.join(F.broadcast(lookup), _condition(on), how)
    return attach_by_merge(fact, lookup, on, how)


def attach_by_merge(fact: DataFrame, lookup: DataFrame, on: Keys, how: str = "left") -> DataFrame:
    """The same join by a shuffle of both sides.

    Adaptive execution splits the partitions of hot fact keys, because a left or inner
    join may split its left side freely. It does so only where each side comes straight
    from its own shuffle, so a lookup that was itself made by key is stored first.
    """
    stored = materialize(lookup, "lookup")
    return fact.join(stored.hint("merge"), _condition(on), how)


def dedupe(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key: the smallest by all remaining columns, so always the same one.

    Spark keeps only the best row of each key per task before the shuffle.
    """
    rest = [name for name in df.columns if name not in keys]
    order = Window.partitionBy(*keys).orderBy(*[F.col(c).asc_nulls_last() for c in rest or keys])
    return (
        df.withColumn("_position", F.row_number().over(order))
        .where("_position = 1")
        .drop("_position")
    )


def zone_lookup(raw: DataFrame, location_type: str = "int") -> DataFrame:
    """The zone lookup with canonical, trimmed columns and one row per location."""
    zones = raw.select(
        F.col("LocationID").cast(location_type).alias("pickup_location_id"),
        F.trim("Borough").alias("pickup_borough"),
        F.trim("Zone").alias("pickup_zone"),
        F.trim("service_zone").alias("pickup_service_zone"),
    )
    return dedupe(zones, ["pickup_location_id"])


def attach_zones(
    trips: DataFrame,
    zones: DataFrame,
    max_rows: int | None = None,
    limit_bytes: int | None = None,
) -> DataFrame:
    return attach(trips, zones, "pickup_location_id", "left", max_rows, limit_bytes)


def attach_hourly(trips: DataFrame, hours: DataFrame, max_rows: int | None = None) -> DataFrame:
    """Attach the condition of the pickup hour."""
    lookup = hours.withColumnRenamed("weather_hour", "pickup_hour")
    return attach(trips, lookup, "pickup_hour", "left", max_rows)


def attach_daily(trips: DataFrame, days: DataFrame, max_rows: int | None = None) -> DataFrame:
    """Attach the condition of the pickup date."""
    lookup = days.withColumnRenamed("weather_date", "pickup_date")
    return attach(trips, lookup, "pickup_date", "left", max_rows)


def missing_keys(expected: DataFrame, present: DataFrame, key: str) -> DataFrame:
    """Expected keys without a row."""
    return expected.join(present.select(key), key, "left_anti")


def match_report(joined: DataFrame, zone: str, condition: str) -> DataFrame:
    """Joined rows, matches of both lookups and their rates, in one pass."""
    counts = joined.agg(
        F.count(F.lit(1)).alias("joined_rows"),
        F.count(zone).alias("zone_matches"),
        F.count(condition).alias("condition_matches"),
    )
    return counts.select(
        "*",
        *[
            F.coalesce(percent(matches, "joined_rows"), F.lit(0.0)).alias(rate)
            for matches, rate in (
                ("zone_matches", "zone_match_rate_pct"),
                ("condition_matches", "condition_match_rate_pct"),
            )
        ],
    )
