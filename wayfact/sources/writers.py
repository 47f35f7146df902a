"""Sinks: Parquet, partitioned Parquet, JSON for small results, CSV conversion."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from wayfact.sources.readers import NULL_TEXT


def output_path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}"


def write_parquet(df: DataFrame, root: str, name: str) -> str:
    """Overwrite one dataset under an output root."""
    path = output_path(root, name)
    df.write.mode("overwrite").parquet(path)
    return path


def write_partitioned(
    df: DataFrame,
    path: str,
    by: Sequence[str],
    rebalance: bool = False,
    only_present: bool = False,
) -> str:
    """Overwrite a dataset split into folders by key.

    ``rebalance`` groups rows by key before the write; Spark then sizes the files
    and splits a key that holds most rows over several tasks. ``only_present`` replaces
    only the folders that occur in ``df``.
    """
    rows = df.hint("rebalance", *[F.col(name) for name in by]) if rebalance else df
    mode = "dynamic" if only_present else "static"
    rows.write.mode("overwrite").option("partitionOverwriteMode", mode).partitionBy(*by).parquet(
        path
    )
    return path


def write_json(df: DataFrame, root: str, name: str) -> str:
    """Write a small result as one JSON file."""
    path = output_path(root, name)
    df.coalesce(1).write.mode("overwrite").json(path)
    return path


def write_csv_quoted(df: DataFrame, path: str) -> str:
    """Write texts of any content as CSV; ``readers.csv_quoted`` reads the same rows back."""
    options = {"header": True, "quoteAll": True, "escape": '"', "nullValue": NULL_TEXT, "emptyValue": ""}
    options |= {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    df.write.mode("overwrite").csv(path, **options)
    return path


def files_of(stored: DataFrame, by: Sequence[str]) -> DataFrame:
    """The files behind a partitioned scan, with the keys of their folder."""
    return stored.select(*by, F.col("_metadata.file_path").alias("file")).distinct()


def csv_to_parquet(spark: SparkSession, source: str, target: str, schema: str) -> DataFrame:
    """Convert a CSV with a declared schema; returns the Parquet copy."""
    spark.read.schema(schema).csv(source, header=True).write.mode("overwrite").parquet(target)
    return spark.read.schema(schema).parquet(target)


def footprint(stored: DataFrame) -> DataFrame:
    """Number and total size of the files behind a scan."""
    files = stored.select("_metadata.file_path", "_metadata.file_size").distinct()
    return files.agg(
        F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("file_size"), F.lit(0)).alias("bytes")
    )
