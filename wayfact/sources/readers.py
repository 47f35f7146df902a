"""Scans: Parquet, CSV in three typings, text, and generated rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

# The ride file's columns.
RIDE_SCHEMA = (
    "ride_id string, rideable_type string, started_at timestamp, ended_at timestamp, "
    "start_station_name string, start_station_id string, end_station_name string, "
    "end_station_id string, start_lat double, start_lng double, end_lat double, "
    "end_lng double, member_casual string"
)

CORRUPT = "corrupt"
NULL_TEXT = "\\N"


def parquet(spark: SparkSession, path: str, columns: Sequence[str] = ()) -> DataFrame:
    """A Parquet file or directory, only the named columns if any."""
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def csv_inferred(spark: SparkSession, path: str) -> DataFrame:
    """A small CSV whose types are inferred; inference reads the file once more."""
    return spark.read.csv(path, header=True, inferSchema=True)


def csv_text(spark: SparkSession, path: str) -> DataFrame:
    """A CSV with every column left as text, to be cast later."""
    return spark.read.csv(path, header=True, inferSchema=False)


def csv_declared(spark: SparkSession, path: str, schema: str = RIDE_SCHEMA) -> DataFrame:
    return spark.read.schema(schema).csv(path, header=True)


def csv_quoted(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A CSV whose quoted fields may hold line ends, quotes, separators and outer blanks.

    A quote inside a field is doubled. An empty quoted field is an empty text, an absent one
    null. Files of such rows cannot be split, so they should be written in moderate sizes.
    """
    options = {"header": True, "multiLine": True, "escape": '"', "nullValue": NULL_TEXT, "emptyValue": ""}
    options |= {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False, "lineSep": "\n"}
    return spark.read.schema(schema).csv(path, **options)


def csv_checked(spark: SparkSession, path: str, schema: str, header: bool = True) -> DataFrame:
    """A CSV with a declared schema, keeping what does not fit.

    ``corrupt`` holds the whole line of a row with a value of another type, too few or too
    many fields; the fields that could be read keep their values, the others are null. It is
    null for a good row.
    """
    declared = f"{schema}, {CORRUPT} string"
    return spark.read.schema(declared).csv(
        path, header=header, mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT
    )


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def rows(spark: SparkSession, data: Sequence[tuple], columns: Sequence[str] | str) -> DataFrame:
    """A few rows given in the program."""
    return spark.createDataFrame(list(data), columns)


def generated(spark: SparkSession, count: int, seed: int = 42) -> DataFrame:
    """Numbered sample trips with seeded random columns."""
    return spark.range(count).select(
        "id",
        (F.rand(seed) * 4 + 1).cast("int").alias("passengers"),
        F.round(F.rand(seed + 1) * 20, 2).alias("distance_km"),
        F.round(F.rand(seed + 2) * 40 + 5, 2).alias("fare"),
        F.when(F.rand(seed + 3) < 0.7, "card").otherwise("cash").alias("payment"),
    )


def temp_view(df: DataFrame, name: str) -> str:
    df.createOrReplaceTempView(name)
    return name
