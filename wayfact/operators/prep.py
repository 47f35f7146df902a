"""Data preparation: imputation, outlier flags, scaling, binning, encoding."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from wayfact.operators.quantiles import exact_quantiles

# Fixed values.
FENCE_FACTOR = 1.5
BIN_LABELS = ("Q1_short", "Q2_medium", "Q3_long", "Q4_very_long")


def median_impute(df: DataFrame, column: str) -> DataFrame:
    """Fill nulls of a column with its median."""
    (median,) = exact_quantiles(df, column, [0.5])
    return df.withColumn(column, F.coalesce(F.col(column), F.lit(median).cast("double")))


def iqr_outliers(df: DataFrame, column: str, flag: str) -> DataFrame:
    """Flag values beyond 1.5 interquartile ranges from the quartiles."""
    lower, upper = exact_quantiles(df, column, [0.25, 0.75])
    if lower is None:
        return df.withColumn(flag, F.lit(None).cast("boolean"))
    reach = FENCE_FACTOR * (upper - lower)
    value = F.col(column)
    return df.withColumn(flag, (value < lower - reach) | (value > upper + reach))


def quartile_bins(df: DataFrame, column: str, out: str) -> DataFrame:
    """Label each value with its quarter of the distribution; nulls fall in the last."""
    cuts = exact_quantiles(df, column, [0.25, 0.5, 0.75])
    label = F.lit(BIN_LABELS[-1])
    for cut, name in reversed(list(zip(cuts, BIN_LABELS))):
        label = F.when(F.col(column) < F.lit(cut).cast("double"), name).otherwise(label)
    return df.withColumn(out, label)


def zscore(df: DataFrame, column: str, out: str) -> DataFrame:
    """Distance from the mean in sample standard deviations.

    Null where the deviation is zero or unknown. Mean and deviation are doubles from one
    aggregation; their last digits can depend on the partitioning.
    """
    value = F.col(column).cast("double")
    stats = df.agg(F.struct(F.avg(value).alias("mean"), F.stddev_samp(value).alias("sd"))).scalar()
    spread = F.nullif(stats.getField("sd"), F.lit(0.0))
    return df.withColumn(out, (value - stats.getField("mean")) / spread)


def one_hot(df: DataFrame, column: str, levels: Mapping[int, str], prefix: str) -> DataFrame:
    """A 0/1 column per level; the level left out is the reference."""
    return df.withColumns(
        {f"{prefix}{name}": (F.col(column) == code).cast("int") for code, name in levels.items()}
    )


def tip_quantiles(df: DataFrame, rate: Column, probabilities: Mapping[str, float]) -> DataFrame:
    """One row with a column per requested quantile of ``rate``."""
    found = exact_quantiles(df.select(rate.alias("rate")), "rate", list(probabilities.values()))
    return df.sparkSession.range(1).select(
        *[F.lit(v).cast("double").alias(name) for name, v in zip(probabilities, found)]
    )
