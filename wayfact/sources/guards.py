"""Checks of columns and types before a job starts."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from wayfact.operators.clean import NUMERIC_COLUMNS, TIMESTAMP_COLUMNS

# Fixed values.
NUMERIC_PREFIXES = ("tinyint", "smallint", "int", "bigint", "float", "double", "decimal")
FILE_SCHEMA = (
    "label string, path string, column_count int, missing array<string>, incompatible array<string>, error string"
)


class SchemaValidationError(RuntimeError):
    """Some inputs do not have the required columns."""


def require_columns(df: DataFrame, required: Iterable[str], dataset: str) -> DataFrame:
    """Return ``df``, or raise naming every missing column in order."""
    missing = sorted(set(required).difference(df.columns))
    if missing:
        raise ValueError(f"{dataset} is missing required columns: {', '.join(missing)}")
    return df


def _footers(times: Sequence[str], numbers: Sequence[str]):
    """A function over file names that checks each footer."""

    def check(batches):
        for batch in batches:
            rows = []
            for label, path in zip(batch.column("label").to_pylist(), batch.column("path").to_pylist()):
                try:
                    filesystem, name = pafs.FileSystem.from_uri(path)
                    with filesystem.open_input_file(name) as file:
                        fields = from_arrow_schema(pq.read_schema(file)).fields
                except (OSError, pa.ArrowException) as error:
                    rows.append((label, path, 0, [], [], str(error).splitlines()[0]))
                    continue
                types = {field.name: field.dataType.simpleString().lower() for field in fields}
                missing = [name for name in (*times, *numbers) if name not in types]
                wrong = [n for n in times if n in types and not types[n].startswith("timestamp")]
                wrong += [n for n in numbers if n in types and not types[n].startswith(NUMERIC_PREFIXES)]
                rows.append((label, path, len(types), missing, [f"{n}={types[n]}" for n in wrong], ""))
            names = ("label", "path", "column_count", "missing", "incompatible", "error")
            kinds = (pa.string(), pa.string(), pa.int32(), pa.list_(pa.string()), pa.list_(pa.string()), pa.string())
            columns = zip(*rows) if rows else [()] * len(names)
            yield pa.record_batch([pa.array(list(c), t) for c, t in zip(columns, kinds)], list(names))

    return check


def file_schemas(
    spark: SparkSession,
    paths: Mapping[str, str],
    times: Sequence[str] = TIMESTAMP_COLUMNS,
    numbers: Sequence[str] = NUMERIC_COLUMNS,
) -> DataFrame:
    """One row per file of the labelled paths, and one for a path without any.

    Files are listed by Spark and their footers read in tasks, a task for some files each.
    """
    listed = spark.createDataFrame([], "label string, path string")
    absent = []
    for label, path in paths.items():
        reader = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet")
        try:
            files = reader.option("recursiveFileLookup", "true").load(path).select(F.lit(label).alias("label"), "path")
        except (PySparkException, Py4JJavaError) as error:
            absent.append((label, path, 0, [], [], str(error).splitlines()[0]))
            continue
        listed = listed.union(files)
    checked = listed.repartition("path").mapInArrow(_footers(times, numbers), FILE_SCHEMA)
    return checked.union(spark.createDataFrame(absent, FILE_SCHEMA))


def schema_report(
    spark: SparkSession,
    paths: Mapping[str, str],
    times: Sequence[str] = TIMESTAMP_COLUMNS,
    numbers: Sequence[str] = NUMERIC_COLUMNS,
) -> DataFrame:
    """One row per labelled path; it passes if every one of its files does.

    ``error`` names the first bad file where a path has good ones too.
    """
    files = file_schemas(spark, paths, times, numbers)
    bad = (F.size("missing") > 0) | (F.size("incompatible") > 0) | (F.col("error") != "")

    def joined(name: str) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(F.flatten(F.collect_list(name)))), ", ").alias(name)

    report = files.groupBy("label").agg(
        F.count_if(bad).alias("bad"),
        F.count("*").alias("files"),
        F.max("column_count").alias("column_count"),
        joined("missing"),
        joined("incompatible"),
        F.min(F.when(bad, F.col("path"))).alias("first_bad"),
        F.coalesce(F.min(F.when(F.col("error") != "", F.col("error"))), F.lit("")).alias("error"),
    )
    named = F.concat(F.lit("in "), "first_bad", F.when(F.col("error") != "", F.concat(F.lit(": "), "error")).otherwise(""))
    labels = spark.createDataFrame([(label,) for label in paths], "label string")
    report = labels.join(report, "label", "left")
    return report.select(
        "label",
        F.when(F.col("bad") == 0, "PASS").otherwise("FAIL").alias("status"),
        F.coalesce("column_count", F.lit(0)).alias("column_count"),
        F.coalesce("missing", F.lit("")).alias("missing"),
        F.coalesce("incompatible", F.lit("")).alias("incompatible"),
        F.when(F.col("files").isNull(), "no files")
        .when((F.col("bad") > 0) & (F.col("files") > F.col("bad")), named)
        .otherwise(F.col("error"))
        .alias("error"),
    )


def require_schemas(report: DataFrame) -> None:
    """Raise with every failed input; the report has one row per input."""
    failed = [row for row in report.collect() if row["status"] != "PASS"]
    if failed:
        lines = "; ".join(
            f"{r['label']}: missing=[{r['missing']}] incompatible=[{r['incompatible']}] {r['error']}"
            for r in failed
        )
        raise SchemaValidationError(f"{len(failed)} inputs failed schema validation: {lines}")


def monthly_paths(root: str, year: int, pattern: str) -> dict[str, str]:
    """Labels and paths of a year's monthly files; ``pattern`` uses {year} and {month}."""
    months = [f"{month:02d}" for month in range(1, 13)]
    base = root.rstrip("/")
    return {f"{year}-{m}": f"{base}/{pattern.format(year=year, month=m)}" for m in months}
