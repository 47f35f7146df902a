"""Exact evaluation of fitted models as Spark aggregations: areas, splits, optimality, importance."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Model
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window, functions as F

from wayfact.session import materialize

SPLIT_BUCKETS = 10_000
# A shuffled column takes its values from rows of the same bucket, so no task sorts more than
# about this many rows.
SHUFFLE_ROWS = 50_000
SMALLEST_PROBABILITY = 1e-15  # log loss of a certain and wrong prediction stays finite


def running_totals(rows: DataFrame, order: Sequence[str], values: Sequence[str]) -> DataFrame:
    """``rows`` with <value>_before: the total of each value over all rows before, by ``order``.

    Rows are dealt to tasks by ranges of the order and summed within each; the totals of the
    ranges, one row a task, give the rest. So no task reads more than its range.
    """
    spark = rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartitionByRange(parts, *order).withColumn("__part", F.spark_partition_id())
    dealt = materialize(dealt, "ranges")
    earlier = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    sums = dealt.groupBy("__part").agg(*(F.sum(v).alias(v) for v in values))
    sums = sums.select("__part", *(F.coalesce(F.sum(v).over(earlier), F.lit(0)).alias(f"__{v}") for v in values))
    within = Window.partitionBy("__part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    placed = dealt.join(F.broadcast(sums), "__part")
    before = {
        f"{v}_before": F.col(f"__{v}") + F.coalesce(F.sum(v).over(within), F.lit(0)) for v in values
    }
    return placed.withColumns(before).drop("__part", *(f"__{v}" for v in values))


def areas_under_roc(rows: DataFrame, label: str, scores: Sequence[str]) -> DataFrame:
    """score, positives, negatives and area: the share of pairs of a positive and a negative in order.

    Pairs of equal scores count half. Rows are first counted by distinct score, then each
    score's positives meet the number of negatives below it, so the area is exact whatever
    the number of rows. Rows without the score or label are left out; NaN is above all
    numbers. A score without positives or without negatives has no area (null).
    """
    long = rows.select(
        F.col(label).cast("double").alias("label"),
        F.explode(
            F.array(*(F.struct(F.lit(s).alias("score"), F.col(s).cast("double").alias("value")) for s in scores))
        ).alias("pair"),
    ).select("label", "pair.score", "pair.value")
    counts = (
        long.where("label is not null and value is not null")
        .groupBy("score", "value")
        .agg(F.count_if(F.col("label") == 1).alias("pos"), F.count_if(F.col("label") != 1).alias("neg"))
    )
    placed = running_totals(materialize(counts, "scores"), ["score", "value"], ["neg"])
    # Twice the pairs in order, counting from the first negative of all scores.
    twice = F.col("pos").cast("decimal(19,0)") * (2 * F.col("neg_before") + F.col("neg")).cast("decimal(19,0)")
    sums = placed.groupBy("score").agg(
        F.sum("pos").alias("positives"),
        F.sum("neg").alias("negatives"),
        F.min("neg_before").alias("base"),
        F.sum(twice).alias("twice"),
    )
    positives, negatives = (F.col(c).cast("decimal(19,0)") for c in ("positives", "negatives"))
    ordered = F.col("twice") - 2 * positives * F.col("base").cast("decimal(19,0)")
    pairs = 2 * positives * negatives
    area = F.when(pairs > 0, ordered.cast("double") / pairs.cast("double"))
    return sums.select("score", "positives", "negatives", area.alias("area"))


def split_bucket(keys: Sequence[str], seed: int) -> Column:
    """A number below ``SPLIT_BUCKETS`` from a row's key alone."""
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), *(F.col(k).cast("string") for k in keys)))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % SPLIT_BUCKETS


def keyed_split(rows: DataFrame, keys: Sequence[str], train: float, seed: int) -> DataFrame:
    """``rows`` with dataset_split, train or test, by a hash of the key.

    The same rows train whatever the partitioning, the order or the rest of the table; rows
    of one key stay together.
    """
    inside = split_bucket(keys, seed) < round(train * SPLIT_BUCKETS)
    return rows.withColumn("dataset_split", F.when(inside, "train").otherwise("test"))


def logistic_certificate(
    scored: DataFrame, features: str, label: str, coefficients: Sequence[float], reg: float
) -> DataFrame:
    """How far a fitted logistic model is from the optimum of its penalised loss, in one pass.

    ``scored`` has the feature vector, the label and the fitted probabilities. The row has the
    number of rows and features, the loss (mean log loss plus half ``reg`` times the squared
    weights) and the largest entry of its gradient, that of the intercept included. At the
    optimum the gradient is zero; no fit reaches a lower loss than one with a zero gradient,
    the loss being convex. Null without rows.
    """
    p = vector_to_array("probability")[1]
    rows = scored.select(
        F.col(label).cast("double").alias("y"),
        F.least(F.greatest(p, F.lit(SMALLEST_PROBABILITY)), F.lit(1 - SMALLEST_PROBABILITY)).alias("p"),
        vector_to_array(features).alias("x"),
    )
    residual = F.col("p") - F.col("y")
    log_loss = -F.when(F.col("y") == 1, F.log("p")).otherwise(F.log(1 - F.col("p")))
    slopes = [F.abs(F.avg(residual * F.col("x")[i]) + reg * w) for i, w in enumerate(coefficients)]
    penalty = reg / 2 * sum(w * w for w in coefficients)
    return rows.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.lit(len(coefficients)).cast("bigint").alias("feature_count"),
        (F.avg(log_loss) + penalty).alias("loss"),
        F.greatest(F.abs(F.avg(residual)), *slopes).alias("gradient"),
    )


def shuffled(rows: DataFrame, keys: Sequence[str], columns: Sequence[str], seed: int) -> DataFrame:
    """``rows`` with shuffled_<column>: each column's values dealt anew among the rows of a bucket.

    Buckets and orders follow from the keys, so the result is the same for any partitioning.
    Within a bucket every value is used once: a row takes that of the next by hash, the last
    that of the first. Rows of equal keys are told apart by their values; a single row of a
    bucket keeps its value.
    """
    buckets = max(1, -(-rows.count() // SHUFFLE_ROWS))
    dealt = rows.withColumn("__bucket", F.pmod(F.xxhash64(F.lit(seed), *keys), F.lit(buckets)))
    for i, column in enumerate(columns):
        order = Window.partitionBy("__bucket").orderBy(F.xxhash64(F.lit(seed + 1 + i), *keys), *keys, column)
        first = F.first(column).over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
        last = F.row_number().over(order) == F.count(F.lit(1)).over(Window.partitionBy("__bucket"))
        dealt = dealt.withColumn(f"shuffled_{column}", F.when(last, first).otherwise(F.lead(column).over(order)))
    return dealt.drop("__bucket")


def permutation_importance(
    model: Model, rows: DataFrame, keys: Sequence[str], columns: Sequence[str], label: str, seed: int
) -> DataFrame:
    """feature, log_loss, importance and rank: what the model loses when one input column is shuffled.

    The importance is the mean log loss with the column shuffled less that without. All
    columns are tried in one scoring pass over the rows times the columns and one.
    """
    own = materialize(shuffled(rows, keys, columns, seed), "shuffled")
    tried = own.withColumn("__tried", F.explode(F.array(*(F.lit(c) for c in ["", *columns]))))
    swapped = {c: F.when(F.col("__tried") == c, F.col(f"shuffled_{c}")).otherwise(F.col(c)) for c in columns}
    scored = model.transform(tried.withColumns(swapped))
    p = vector_to_array("probability")[1]
    p = F.least(F.greatest(p, F.lit(SMALLEST_PROBABILITY)), F.lit(1 - SMALLEST_PROBABILITY))
    loss = -F.when(F.col(label) == 1, F.log(p)).otherwise(F.log(1 - p))
    losses = materialize(scored.groupBy("__tried").agg(F.avg(loss).alias("log_loss")), "losses")
    plain = losses.where("__tried = ''").select("log_loss").scalar()
    found = losses.where("__tried <> ''").select(
        F.col("__tried").alias("feature"),
        F.round("log_loss", 8).alias("log_loss"),
        F.round(F.col("log_loss") - plain, 8).alias("importance"),
    )
    return found.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("importance"), "feature")))


def feature_rows(
    assembled: DataFrame, keys: Sequence[str], names: Sequence[str], column: str, places: int = 6
) -> DataFrame:
    """One row per key and slot of an assembled vector: the keys, feature and value (rounded)."""
    labels = F.array(*(F.lit(name) for name in names))
    slots = assembled.select(*keys, F.posexplode(vector_to_array(column)).alias("slot", "value"))
    return slots.select(*keys, labels[F.col("slot")].alias("feature"), F.round("value", places).alias("value"))
