"""Catalog tables over Parquet directories."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def register_table(
    spark: SparkSession,
    name: str,
    path: str,
    schema: str | None = None,
    partitioned_by: Sequence[str] = (),
) -> DataFrame:
    """Bind a table name to a directory; partition folders are discovered afterwards."""
    columns = f"({schema})" if schema else ""
    spec = f"PARTITIONED BY ({', '.join(partitioned_by)})" if partitioned_by else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} {columns} USING parquet {spec} LOCATION '{path}'")
    if partitioned_by:
        recover_partitions(spark, name)
    return spark.table(name)


def recover_partitions(spark: SparkSession, name: str) -> None:
    spark.sql(f"MSCK REPAIR TABLE {name}")
